"""Session settings the jobs depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

PINNED = {
    # The day of an order is taken in the session time zone.
    "spark.sql.session.timeZone": "UTC",
    # pandas writes nanosecond timestamps, which Spark reads only as longs;
    # sources.chunks turns them back into timestamps.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # A store or order holding a large share of all rows must not end in one task.
    # Spark splits such join partitions at run time, but by default not where an
    # aggregate could otherwise reuse the partitioning of the join.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Partitions that Spark joins up again, after a shuffle, stay small enough to be sorted in memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # So do pieces of files: a task that folds rows before a shuffle may hold a row per key of its piece.
    "spark.sql.files.maxPartitionBytes": "16m",
    # A few files open at once instead of a sort of whole rows by the folder they go to.
    OPEN_FILES: "16",
    # Stored tables are most of what a load writes. At level 9 files of chunk rows are 3 % smaller than
    # at 3, for three times the CPU time.
    "spark.sql.parquet.compression.codec": "zstd",
    "parquet.compression.codec.zstd.level": "3",
    # Columns whose values hardly repeat: a dictionary of them takes time and makes files larger.
    **{f"parquet.enable.dictionary#{c}": "false" for c in (
        "id", "order_id", "user_id", "item_id", "item_replaced_id", "chunk_row", "user_phone",
    )},
}

# Parquet bytes of the input for each partition a shuffle begins with: some 150,000 chunk rows,
# whatever the input's size. Spark joins up partitions that turn out small.
PARTITION_BYTES = 4 << 20
_MOST_PARTITIONS = 20_000
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def pin(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session and return it."""
    for key, value in PINNED.items():
        spark.conf.set(key, value)
    return spark


def partitions(spark: SparkSession) -> int:
    """Partitions that shuffles begin with."""
    default = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get(_PARTITIONS, None) or default)


def fit(spark: SparkSession, size: int) -> None:
    """Let shuffles begin with as many partitions as ``size`` bytes of input need, so that what a
    task holds doesn't grow with the input. Never with fewer than before."""
    wanted = min(_MOST_PARTITIONS, -(-size // PARTITION_BYTES))
    if wanted > partitions(spark):
        spark.conf.set(_PARTITIONS, str(wanted))


def local_session(cpus: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("waybill")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = pin(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
