"""Near-duplicate groups by one-permutation MinHash, with exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import among, marked, row_key, without, written
from waybill.llm.hashing import Block, blocks, mixed

SHINGLE = 5
SIMILARITY_PERCENT = 75
BANDS, ROWS = 32, 4
BINS = BANDS * ROWS  # a power of two
# Stars go on while more than one in so many of a round's pairs is a link.
STAR_GAIN = 100
# A bucket that stars leave open is compared in tiles of about so many documents and shingles.
TILE_MEMBERS, TILE_SHINGLES = 1000, 500_000
# Shingles of more documents than this are counted by a matrix product, others one by one.
_OFTEN = 32
_EMPTY = np.uint64(2**64 - 1)


def shingle_sets(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted, document by document, and each one's document.

    Texts with fewer words than a shingle have one: the whole sequence.
    """
    found, place = block.windows(size)
    owner = block.owner(place)
    short = np.flatnonzero((block.count > 0) & (block.count < size))
    if len(short):
        whole = block.spans(block.start[short], block.start[short + 1])
        found, owner = np.concatenate([found, whole]), np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[first], owner[first]


def signatures(found: np.ndarray, owner: np.ndarray, documents: int) -> np.ndarray:
    """One-permutation MinHash: the hash space is cut into bins, and each bin keeps its
    least hash. An empty bin takes the value of another, found by hashing the bin and the
    number of the attempt until a filled one turns up (optimal densification)."""
    bins = (found >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    # Sorted by document and hash: the first hash of a bin is its least.
    first = np.ones(len(found), bool)
    first[1:] = (bins[1:] != bins[:-1]) | (owner[1:] != owner[:-1])
    table = np.full((documents, BINS), _EMPTY)
    table[owner[first], bins[first]] = found[first]
    filled = table != _EMPTY
    donors = table.copy()
    # With one filled bin every search ends there.
    single = np.flatnonzero(filled.sum(axis=1) == 1)
    table[single] = table[single].min(axis=1)[:, None]
    rows, columns = np.nonzero((table == _EMPTY) & filled.any(axis=1)[:, None])
    attempt = 0
    while len(rows):
        attempt += 1
        probe = mixed((columns + BINS * attempt).astype(np.uint64)) % np.uint64(BINS)
        value = donors[rows, probe.astype(np.int64)]
        hit = value != _EMPTY
        table[rows[hit], columns[hit]] = value[hit]
        rows, columns = rows[~hit], columns[~hit]
    return table


def band_keys(table: np.ndarray) -> np.ndarray:
    """One key per document and band, different from band to band."""
    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(table), 1))
    for row in range(ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + table[:, row::ROWS])
    return keys


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(1), lower=True):
            found, owner = shingle_sets(block, SHINGLE)
            size = np.bincount(owner, minlength=block.size)
            bounds = np.r_[0, np.cumsum(size)]
            # Two sums over the set, equal for equal sets.
            one, two = (
                np.r_[np.uint64(0), np.cumsum(v, dtype=np.uint64)]
                for v in (mixed(found), mixed(found ^ _EMPTY))
            )
            keys = band_keys(signatures(found, owner, block.size)).view(np.int64)
            lists = pa.ListArray.from_arrays(
                np.arange(0, BANDS * block.size + 1, BANDS, dtype=np.int32), keys.ravel()
            )
            yield pa.record_batch(
                [*[batch.column(i).slice(block.first, block.size) for i in (0, 2)],
                 pa.array(size.astype(np.int64)),
                 *[pa.array((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64)) for s in (one, two)],
                 lists],
                names=["doc_id", "row_key", "n_shingles", "set_a", "set_b", "bands"],
            )


def _similar(percent: int):
    """Of (a, b, text_a, text_b) the pairs similar enough, counted on full sets."""
    def sets(texts: pa.Array) -> list[np.ndarray]:
        out = []
        for block in blocks(texts, lower=True):
            found, owner = shingle_sets(block, SHINGLE)
            bounds = np.searchsorted(owner, np.arange(block.size + 1))
            out += [found[bounds[k]: bounds[k + 1]] for k in range(block.size)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keep = []
                for one, two in zip(sets(part.column(2)), sets(part.column(3))):
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    keep.append(both > 0 and 100 * both >= percent * (len(one) + len(two) - both))
                yield pa.record_batch(
                    [part.column(0), part.column(1)], names=["a", "b"]
                ).filter(pa.array(keep, pa.bool_()))

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return (
        pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        .mapInArrow(_similar(percent), "a long, b long")
    )


def least_reachable(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each linked node can reach.

    Each round every node takes the least label among its own and its neighbours', and then
    the label's own label. Minima are combined before they are shuffled, and joins on
    a hub are split by adaptive execution. Ends when no label has changed.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    edges = written(both.distinct(), "edges")
    labels = edges.groupBy("node").agg(
        F.least(F.col("node"), F.min("other")).alias("component")
    )
    labels = written(labels, "labels")
    while True:
        of_other = labels.select(F.col("node").alias("other"), F.col("component").alias("seen"))
        seen = edges.join(of_other, "other").groupBy("node").agg(F.min("seen").alias("seen"))
        nearer = labels.join(seen, "node").select(
            "node", F.least("component", "seen").alias("nearer"), F.col("component").alias("old")
        )
        of_label = labels.select(F.col("node").alias("nearer"), F.col("component").alias("jump"))
        moved = nearer.join(of_label, "nearer").select(
            "node", F.least("nearer", "jump").alias("component"), "old"
        )
        moved = written(moved, "labels")
        changed = not moved.filter("component < old").isEmpty()
        labels = moved.drop("old")
        if not changed:
            return labels


def hubs_of(members: DataFrame) -> DataFrame:
    """(bucket, a, n_a, component_a): the member of each bucket that meets most documents.

    An original meets all of its edited copies, which may not be similar to each other.
    """
    order = F.struct("met", (-F.col("id")).alias("id"), "n", "component")
    return members.groupBy("bucket").agg(F.max(order).alias("hub")).select(
        "bucket", (-F.col("hub.id")).alias("a"), F.col("hub.n").alias("n_a"),
        F.col("hub.component").alias("component_a"),
    )


def star_edges(members: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    """(a, b): each bucket's hub with each other member that is not in its group yet.
    Pairs too unequal in size to be similar are left out."""
    low, high = F.least("n", "n_a"), F.greatest("n", "n_a")
    new = (F.col("component") != F.col("component_a")) & (low * 100 >= high * percent)
    pairs = members.join(hubs, "bucket").filter(new)
    return pairs.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()


def _hash_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, text) the shingle set as hashes in one byte string."""
    for batch in batches:
        for block in blocks(batch.column(1), lower=True):
            found, owner = shingle_sets(block, SHINGLE)
            bounds = np.searchsorted(owner, np.arange(block.size + 1))
            sets = [found[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.record_batch(
                [batch.column(0).slice(block.first, block.size), pa.array(sets, pa.binary())],
                names=["id", "shingles"],
            )


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every two sets, each without repeats."""
    most = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(most), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    start = np.flatnonzero(np.r_[True, values[1:] != values[:-1]][: len(values)])
    count = np.diff(np.r_[start, len(values)])
    common = np.zeros(most * most, np.float32)
    for times in range(2, _OFTEN + 1):
        rows = owner[start[count == times][:, None] + np.arange(times)]
        np.add.at(common, (rows[:, :, None] * most + rows[:, None, :]).ravel(), 1)
    common = common.reshape(most, most)
    often = np.flatnonzero(count > _OFTEN)
    for at in range(0, len(often), 1024):
        chosen = often[at: at + 1024]
        has = np.zeros((most, len(chosen)), np.float32)
        for column, k in enumerate(chosen):
            has[owner[start[k]: start[k] + count[k]], column] = 1
        common += has @ has.T
    return common


def _links_in_tile(percent: int, spanning: bool):
    """Pairs of a tile's similar documents of different groups; if ``spanning``, only as many
    as it takes to connect those groups, so never more than documents."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", ignore_index=True)
        ids, group = frame["id"].to_numpy(), frame["component"].to_numpy().copy()
        sets = [np.frombuffer(b, np.uint64) for b in frame["shingles"]]
        n = np.array([len(s) for s in sets])
        counts = common_counts(sets)
        found = []
        for i in range(len(ids) - 1):
            both = counts[i, i + 1:].astype(np.int64)
            enough = (100 + percent) * both >= percent * (n[i] + n[i + 1:])
            hit = np.flatnonzero(enough & (group[i + 1:] != group[i])) + i + 1
            if spanning:
                joined, first = np.unique(group[hit], return_index=True)
                hit = hit[first]
                group[np.isin(group, joined)] = group[i]
            found += [(ids[i], ids[j]) for j in hit]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _told_apart(members: DataFrame) -> DataFrame:
    """(bucket, tiles): buckets that hold several groups, of buckets with the same members
    one, as the others give the same pairs."""
    parts = []
    for seed in (1, 2):
        value = F.xxhash64(F.lit(seed), "id", "n", "component")
        parts += [value.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(value, 32)]
    buckets = members.groupBy("bucket").agg(
        F.ceil(F.greatest(F.count("*") / TILE_MEMBERS, F.sum("n") / TILE_SHINGLES)).alias("tiles"),
        F.min("component").alias("low"), F.max("component").alias("high"),
        # Sums over the members, equal for equal members.
        F.count("*").alias("members"), *[F.sum(v).alias(f"sum_{k}") for k, v in enumerate(parts)],
    )
    same = ["members", *[f"sum_{k}" for k in range(len(parts))]]
    return buckets.filter("low < high").groupBy(*same).agg(
        F.min("bucket").alias("bucket"), F.max("tiles").alias("tiles")
    ).select("bucket", "tiles")


def pairs_in_tiles(
    members: DataFrame, texts: DataFrame, percent: int, spanning: bool = False
) -> DataFrame:
    """(a, b): members of one bucket, in different groups, that are similar on full sets.
    If ``spanning``, a tile gives only the pairs that it takes to connect its groups.

    A bucket is cut into tiles of bounded size and every two tiles are compared as a task's
    matrix. So even a huge bucket is many tasks, and only similar pairs become rows.
    Buckets of one group, and buckets with the members of another one, are left out.
    """
    members = written(members.join(_told_apart(members), "bucket"), "tiled")
    ids = written(members.select("id").distinct(), "ids")
    sets = written(
        among(texts.select("id", "text"), "id", ids)
        .mapInArrow(_hash_sets, "id long, shingles binary"),
        "sets",
    )
    tile = F.pmod(F.xxhash64("id"), F.col("tiles"))
    # Every tile meets every other; a single one, itself.
    others = F.filter(
        F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda t: (t != tile) | (F.col("tiles") == 1)
    )
    tiled = members.select(
        "bucket", "id", "n", "component", tile.alias("tile"), F.explode(others).alias("other")
    )
    return (
        tiled.join(sets, "id").groupBy(
            "bucket", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")
        )
        .applyInPandas(_links_in_tile(percent, spanning), "a long, b long").distinct()
    )


def near_duplicates(
    docs: DataFrame, percent: int = SIMILARITY_PERCENT, keyed: bool = False
) -> DataFrame:
    """Group the rows of ``docs`` (doc_id, text) whose word shingle sets are similar.

    A-Z is lower-cased. A set holds the distinct 5-word shingles, of a shorter text the
    whole sequence. Documents are linked if 100 * common >= percent * union;
    a group is what links reach. Texts without words, and null texts, are linked with
    nothing. Rows with equal doc_id are one document. A null doc_id never stands for a group: such
    a row gets the component of its set, null if nobody else has it.

    1. Documents with equal sets form a class, represented by its least doc_id; only
       representatives go on, so a group of copies of any size is one row.
    2. One-permutation signatures in 32 bands of 4: a pair of similarity 0.75 shares
       no band with a probability of 5e-6.
    3. Each bucket gives a star: its best connected document with each other one.
       Links are confirmed on full sets. While buckets hold several groups and more than
       1 % of a round's pairs are links, each such bucket gives a star around its next best document.
    4. What stars leave over, members of a bucket in different groups, is compared in tiles
       on full sets. So no group is torn because neither document was a hub.

    Columns: doc_id, n_shingles, component_id, kept (doc_id = component_id); if ``keyed``, row_key
    (of id and text, see ``frames``).
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = written(
        plain.withColumn("row_key", row_key()).mapInArrow(
            _sketch, "doc_id long, row_key long, n_shingles long, set_a long, set_b long, "
            "bands array<long>",
        ),
        "sketches",
    )
    own_set = ["set_a", "set_b", "n_shingles"]
    classes = sketches.filter("n_shingles > 0").groupBy(*own_set).agg(F.min("doc_id").alias("id"))
    classes = written(classes, "classes")
    # A repeated row is folded where it is read.
    own = sketches.filter("n_shingles > 0").groupBy("doc_id", *own_set).agg(F.first("bands").alias("bands"))
    representatives = written(
        own.join(classes.select("id", *[F.col(c).alias(f"_{c}") for c in own_set]),
                 (F.col("doc_id") == F.col("id")) & (F.col("set_a") == F.col("_set_a"))
                 & (F.col("set_b") == F.col("_set_b")) & (F.col("n_shingles") == F.col("_n_shingles")))
        .select("id", F.col("n_shingles").alias("n"), "bands"),
        "representatives",
    )
    rows = representatives.select("id", "n", F.explode("bands").alias("bucket"))
    sizes = written(rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    # Most buckets hold one document, whose rows need no shuffle.
    shared = marked(rows, F.col("bucket"), sizes.select("bucket"), "shared").filter("shared")
    members = written(shared.drop("shared").join(sizes, "bucket"), "members")
    met = members.groupBy("id").agg(F.sum("size").alias("met"))
    members = written(members.drop("size").join(met, "id"), "members")
    wanted = written(members.select(F.col("id").alias("doc_id")).distinct(), "wanted")
    # An id with several texts has one of them here, whichever is least.
    texts = written(
        among(plain, "doc_id", wanted).groupBy(F.col("doc_id").alias("id"))
        .agg(F.min("text").alias("text")),
        "texts",
    )
    links = used = tried = None
    open_members = members.withColumn("component", F.col("id"))
    while True:
        hubs = written(hubs_of(open_members), "hubs")
        pairs = star_edges(open_members, hubs, percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        found = written(confirmed(pairs, texts, percent), "links")
        links = found if links is None else links.unionByName(found)
        if found.count() * STAR_GAIN <= pairs.count():
            break
        components = least_reachable(links)
        tried = pairs if tried is None else tried.unionByName(pairs)
        own_hubs = hubs.select("bucket", F.col("a").alias("id"))
        used = own_hubs if used is None else used.unionByName(own_hubs)
        labelled = members.join(
            components.withColumnRenamed("node", "id"), "id", "left"
        ).withColumn("component", F.coalesce("component", "id"))
        split = labelled.groupBy("bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        ).filter("low < high").select("bucket")
        open_members = written(
            labelled.join(split, "bucket").join(used, ["bucket", "id"], "left_anti"), "members"
        )
    rest = written(pairs_in_tiles(open_members, texts, percent, spanning=True), "rest")
    groups = _grouped(sketches, classes, least_reachable(links.unionByName(rest)))
    return groups if keyed else groups.drop("row_key")


def _grouped(sketches: DataFrame, classes: DataFrame, components: DataFrame) -> DataFrame:
    same = [F.col(c) == F.col(f"_{c}") for c in ("set_a", "set_b", "n_shingles")]
    named = classes.select("id", *[F.col(c).alias(f"_{c}") for c in ("set_a", "set_b", "n_shingles")])
    named = named.join(components.withColumnRenamed("node", "id"), "id", "left")
    named = named.withColumn("id", F.coalesce("component", "id")).drop("component")
    component = F.when(F.col("n_shingles") > 0, F.col("id")).otherwise(F.col("doc_id"))
    return sketches.join(named, same, "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), "row_key",
    )


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each of the keyed
    ``groups``.

    Rows go by id and text, so of rows without an id, or with one that other texts have,
    too, only those go whose own text is a copy.
    """
    return without(docs, groups.filter(~F.col("kept")))
