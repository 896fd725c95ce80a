import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def edge_rows():
    long_text = " ".join(f"w{i * i % 7919}" for i in range(30_000))
    passage = " ".join(f"shared{i}" for i in range(50))
    return [
        (None, None, "s1"), (None, "only words of nobody", None), (9001, "", "s1"),
        (9002, None, None), (9003, " \t\n\x0b\x0c\r ", "s1"), (9004, "a b c", "s1"),
        (9004, "a b c", "s1"), (9005, "A B c", "s1"), (9006, "a b c", None),
        (9007, long_text, "s1"), (9008, passage + " one end", "s1"),
        (9009, "another start " + passage, "s2"),
        (9010, "Café İstanbul ΣΑΣ <|endoftext|> x\x1cy", "s2"),
        (9011, "CC BY\nAll, rights (reserved) GNU General  Public-License cc by cc by", "s2"),
        (9012, "mail a.b@c.de. +1 (377) 555-0271 4111 1111 1111 1111 10.0.0.256 10.0.0.25", "s2"),
        (9013, "1" * 3000 + " " + "x" * 3000 + "@", "s2"),
    ]


@pytest.fixture(scope="session")
def docs(spark, edge_rows):
    """All documents of the smallest tables, with edge cases and columns that clash."""
    edges = spark.createDataFrame(edge_rows, "doc_id long, text string, source string")
    whole = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    clashing = ("row_key", "key", "_key", "words", "rows", "host", "line", "digest", "shard", "id",
                "_row_key", "_row", "text_sha256", "bucket", "place", "kept")
    rows = whole.unionByName(edges).repartition(3)
    return rows.withColumns({c: F.lit(1) for c in clashing})


@pytest.fixture(scope="session")
def none(docs):
    return docs.filter("false")


@pytest.fixture(scope="session")
def plain(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
