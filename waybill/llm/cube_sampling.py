"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.frames import new_name, row_key, text_of, words_of, written

WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3
# Units of a source that one task moves through the constraints.
CELL_UNITS = 4_000
_EPS = 1e-9


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Add weight, target and rate to (source, source_size): one row per source.

    Sources in code point order, null last, get the weights in turn. Targets share the
    sum of all sizes by weight; none is above ``most`` times its source's size. What is
    cut is shared again, until none is above: target = min(most * size, level * weight).
    Ordered by cap / weight, the level is the largest of (rest of the sum) / (rest of
    the weights), as it grows while caps bind and falls afterwards.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * float(most)
    ranked = sources.withColumn("place", place).withColumn("weight", weight).withColumn("cap", cap)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = ranked.withColumn("level", rest / open_weight)
    target = F.least(F.col("cap"), F.max("level").over(everything) * F.col("weight"))
    return levelled.select(
        "source", "place", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def flight(chance: np.ndarray, words: np.ndarray, rows: np.ndarray, seed: Sequence[int]) -> np.ndarray:
    """Move inclusion probabilities to 0 or 1, keeping the sums of chance * words and
    chance * rows, until two at most are left in between.

    Units enter one by one. As soon as three are open, their probabilities move along
    the null space of the two constraints, in one of its two directions at random such
    that each keeps its expectation, until one of them arrives at 0 or 1.
    """
    chance = chance.astype(float).tolist()
    words, rows = words.astype(float).tolist(), rows.astype(float).tolist()
    draws = iter(np.random.default_rng(list(seed)).random(len(chance) + 1).tolist())
    open_units: list[int] = []
    for unit in range(len(chance)):
        if _EPS < chance[unit] < 1 - _EPS:
            open_units.append(unit)
        if len(open_units) < 3:
            continue
        a, b, c = open_units
        move = [
            words[b] * rows[c] - words[c] * rows[b],
            words[c] * rows[a] - words[a] * rows[c],
            words[a] * rows[b] - words[b] * rows[a],
        ]
        if max(map(abs, move)) < _EPS:  # proportional constraints: two units suffice
            move = [rows[b], -rows[a], 0.0]
        up = down = float("inf")
        for v, k in zip(move, open_units):
            if v > 0:
                up, down = min(up, (1 - chance[k]) / v), min(down, chance[k] / v)
            elif v < 0:
                up, down = min(up, chance[k] / -v), min(down, (1 - chance[k]) / -v)
        step = up if next(draws) * (up + down) < down else -down
        for v, k in zip(move, open_units):
            chance[k] = min(1.0, max(0.0, chance[k] + step * v))
            if not _EPS < chance[k] < 1 - _EPS:
                chance[k] = round(chance[k])
        open_units = [k for k in open_units if 0 < chance[k] < 1]
    return np.array(chance)


def land(
    chance: np.ndarray, words: np.ndarray, rows: np.ndarray, wanted: float
) -> np.ndarray:
    """The landing problem. The few units left open are rounded, of all ways the one
    nearest in words, then in rows. If a large unit was among them, single units change
    sides as long as that brings the words nearer to ``wanted``, the most helpful first."""
    left = np.flatnonzero((chance > 0) & (chance < 1))
    ways = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    off = ways - chance[left]
    best = np.lexsort((np.abs(off @ rows[left]), np.abs(off @ words[left])))[0]
    chance = chance.copy()
    chance[left] = ways[best]
    for _ in range(len(chance)):
        missing = wanted - chance @ words
        change = np.where(chance == 0, words, -words)
        unit = int(np.argmin(np.abs(missing - change)))
        if abs(missing - change[unit]) >= abs(missing) - 0.5:
            break
        chance[unit] = 1 - chance[unit]
    return chance


_SCHEMA = "place int, cell long, doc_id long, row_key long, words long, rows long, chance double"


def _fly(level: int, last: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(
            ["words", "row_key", "doc_id"], ascending=[False, True, True], ignore_index=True
        )
        seed = [level, int(frame["place"].iloc[0]), int(frame["cell"].iloc[0])]
        words, rows = frame["words"].to_numpy(), frame["rows"].to_numpy()
        before = frame["chance"].to_numpy()
        if not before.any():
            return frame
        moved = flight(before, words, rows, seed)
        return frame.assign(chance=land(moved, words, rows, before @ words) if last else moved)

    return run


def balanced_picks(units: DataFrame, most_units: int, cell_units: int = CELL_UNITS) -> DataFrame:
    """0 or 1 for every unit (place, doc_id, row_key, words, rows, chance).

    Units are hashed into cells, so a source with a third of all rows is many tasks. A
    cell leaves two units open at most. These meet in fewer cells, level by level, until
    a source is one cell, where the last two are rounded. Large units come first, so
    the ones left over are the smallest. Random numbers depend on the level, the source
    and the cell alone: reruns agree.
    """
    cells, level, done = max(1, ceil(most_units / cell_units)), 0, []
    while True:
        last = cells == 1
        cell = F.pmod(F.xxhash64("row_key", "doc_id", F.lit(level)), F.lit(cells))
        flown = units.withColumn("cell", cell).select(
            "place", "cell", "doc_id", "row_key", "words", "rows", "chance"
        ).groupBy("place", "cell").applyInPandas(_fly(level, last), _SCHEMA)
        flown = written(flown, f"flight-{level}")
        settled = (F.col("chance") == 0) | (F.col("chance") == 1)
        done.append(flown.filter(settled))
        if last:
            break
        units = flown.filter(~settled).drop("cell")
        cells, level = max(1, ceil(cells * 2 / cell_units)), level + 1
    picks = done[0]
    for more in done[1:]:
        picks = picks.unionByName(more)
    return picks.withColumn("pick", F.col("chance").cast("int")).drop("cell", "chance")


def mix_sources(
    docs: DataFrame, source: str = "source", weights: Sequence[float] = WEIGHTS,
    most: int = MOST_COPIES, cell_units: int = CELL_UNITS,
) -> DataFrame:
    """How often each row of ``docs`` (doc_id, text, source) enters the mix.

    The size of a row is its number of words (null text: 0). A source is taken
    target / source_size times over (``targets``): every row as often as that has
    whole times, and once more for a balanced sample with the rest as probability, which
    keeps the totals of words and of rows. Rows of size 0 are sampled like any other.
    Rows equal in id, text and source are one unit and are taken alike. A null source
    is a source. An empty table gives an empty result.

    Columns, one row per input row: doc_id, size, source_size, target, taken (words,
    repeats counted), copies, source, row_key.
    """
    sized = docs.select(
        F.col(source).alias("source"), "doc_id", row_key().alias("row_key"),
        F.size(words_of(text_of())).cast("long").alias("words"),
    )
    units = written(
        sized.groupBy("source", "doc_id", "row_key", "words").agg(F.count("*").alias("rows")), "units"
    )
    totals = units.groupBy("source").agg(
        F.sum(F.col("words") * F.col("rows")).alias("source_size"), F.count("*").alias("units")
    )
    goals = written(targets(totals.drop("units"), weights, most), "targets").withColumnRenamed(
        "source", "_source"
    )
    most_units = totals.agg(F.coalesce(F.max("units"), F.lit(0))).first()[0]
    whole = F.floor(F.col("rate") + 1e-12)
    aimed = units.join(goals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    aimed = aimed.withColumn("whole", whole)
    chance = F.greatest(F.lit(0.0), F.col("rate") - F.col("whole"))
    picks = balanced_picks(
        aimed.select("place", "doc_id", "row_key",
                     (F.col("words") * F.col("rows")).alias("words"), "rows", chance.alias("chance")),
        most_units, cell_units,
    ).select(F.col("place").alias("_place"), F.col("doc_id").alias("_id"),
             F.col("row_key").alias("_key"), "pick")
    same = (
        (F.col("place") == F.col("_place")) & (F.col("row_key") == F.col("_key"))
        & F.col("doc_id").eqNullSafe(F.col("_id"))
    )
    copies = (F.col("whole") + F.col("pick")).cast("int")
    return (
        aimed.join(picks, same)
        .withColumn("copies", copies)
        .select(
            "doc_id", F.col("words").alias("size"), "source_size", "target",
            (F.col("words") * F.col("copies")).alias("taken"), "copies", "source", "row_key",
            F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_row"),
        )
        .drop("_row")
    )


def mixture(docs: DataFrame, decisions: DataFrame, source: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as decided, with all their columns."""
    wanted = written(
        decisions.filter("copies > 0").select(
            F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"),
            F.col("source").alias("_source"), "copies",
        ).distinct().withColumnRenamed("copies", "_copies"),
        "copies",
    )
    key, row = new_name(docs, "_row_key"), new_name(docs, "_row")
    same = (
        (F.col(key) == wanted["_key"]) & docs["doc_id"].eqNullSafe(wanted["_id"])
        & docs[source].eqNullSafe(wanted["_source"])
    )
    times = F.explode(F.sequence(F.lit(1), wanted["_copies"])).alias(row)
    return (
        docs.withColumn(key, row_key()).join(wanted, same)
        .select(*[docs[c] for c in docs.columns], times).drop(row)
    )
