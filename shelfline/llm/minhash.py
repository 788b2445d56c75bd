"""Near-duplicates by min-max hashing.

Each permutation of the shingles gives both its minimum and its maximum, so a signature of 200 values takes 100 hash
evaluations per shingle. Bands of five values make buckets; every link is confirmed on the full shingle sets.

No step lists all pairs of a bucket. Documents with equal sets are one node from the start. In each bucket every node is
compared with the bucket's smallest node; what that links is merged. Only buckets that still hold several components are
compared further: the nodes outside the bucket's largest component against the rest, block by block, giving out no more
links than it takes to join them. At similarity 0.75 a pair shares none of the 40 bands with probability 2e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.components import components
from shelfline.llm.joins import join_counted, may_match, packed, total, unpacked
from shelfline.llm.text import blocks, column, distinct, mix, prepare, reduce_by_text, shingles, span_hash
from shelfline.session import discard, materialize

WIDTH, PERMUTATIONS, ROWS_PER_BAND = 5, 100, 5
BLOCK_NODES, BLOCK_SHINGLES = 512, 1 << 20
_random = np.random.default_rng(41)
_FACTORS = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_WEIGHTS = _random.integers(0, 1 << 63, ROWS_PER_BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(block) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles, in order, and where each text's begin."""
    starts, ends, first = block.words()
    words = span_hash(block.prefix(lower=True), starts, ends)
    values, _, first = distinct(*shingles(words, first, WIDTH))
    return values, first


def band_keys(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of bucket keys per text: bands of minima, then of maxima of the same permutations."""
    n, bands = len(first) - 1, PERMUTATIONS // ROWS_PER_BAND
    keys = np.zeros((2 * bands, n), np.uint64)
    for p in range(PERMUTATIONS):
        moved = values * _FACTORS[p] + _SHIFTS[p]
        band, weight = p // ROWS_PER_BAND, _WEIGHTS[p % ROWS_PER_BAND]
        keys[band] += reduce_by_text(np.minimum, moved, first, 0) * weight
        keys[bands + band] += reduce_by_text(np.maximum, moved, first, 0) * weight
    keys += np.arange(2 * bands, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    return mix(keys).T


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (16 bytes that equal sets share) and bands of every whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                values, first = shingle_sets(block)
                n = np.diff(first)
                one = reduce_by_text(np.add, mix(values ^ np.uint64(0x1B873593)), first, 0) + n.astype(np.uint64)
                two = reduce_by_text(np.bitwise_xor, mix(values ^ np.uint64(0xCC9E2D51)), first, 0)
                keys = band_keys(values, first)
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(block.first, block.n),
                    "text_key": batch.column("text_key").slice(block.first, block.n),
                    "n_shingles": column(n.astype(np.int64)),
                    "set_key": pa.array([row.tobytes() for row in np.stack([one, two], 1)], pa.binary()),
                    "bands": pa.ListArray.from_arrays(
                        np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32), column(np.ascontiguousarray(keys).ravel()))})

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        work, "doc_id long, text_key long, n_shingles long, set_key binary, bands array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and shingles (its whole set) of the wanted nodes (node, doc_id, text_key, a stored table). Most texts are not wanted and stay
    where they are: a bitmap of the wanted keys leaves them out before the shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                values, first = shingle_sets(block)
                yield pa.record_batch({
                    "node": batch.column("node").slice(block.first, block.n),
                    "shingles": pa.ListArray.from_arrays(pa.array(first, pa.int32()), column(values))})

    wanted = wanted.select("node", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    texts = may_match(texts, "text_key", wanted, "_key")
    found = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).select("node", "text")
    # Rows repeated in the input would come twice.
    return found.mapInArrow(work, "node long, shingles array<long>").dropDuplicates(["node"])


def sets_among(sets: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """The sets of the nodes in `column` of `rows`, and few others. A join of sets then shuffles about as many as it keeps."""
    marked = sets.withColumn("_place", F.xxhash64("node"))
    return may_match(marked, "_place", rows.select(F.xxhash64(column).alias("_wanted")), "_wanted").drop("_place")


def linked(common, a, b):
    return 100 * common >= 75 * (a + b - common)


def block_links(rows: pa.Table) -> pa.Table:
    """Links between different components of one block of a bucket, as few as join them: pairs of component roots."""
    side, node, root = (rows.column(c).to_numpy() for c in ("side", "node", "root"))
    sets = rows.column("shingles").combine_chunks()
    values, first = sets.values.to_numpy(), sets.offsets.to_numpy()
    size = np.diff(first)
    owner = np.repeat(np.arange(len(size)), size)
    values = values[first[0] : first[-1]]
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    place = np.empty(len(side), np.int64)
    place[left], place[right] = np.arange(len(left)), np.arange(len(right))
    names, rank = np.unique(values, return_inverse=True)
    is_left = side[owner] == 0
    shared = (np.bincount(rank[is_left], minlength=len(names)) > 0) & (np.bincount(rank[~is_left], minlength=len(names)) > 0)
    rank, keep = (np.cumsum(shared) - 1)[rank], shared[rank]
    rank, owner, is_left = rank[keep], owner[keep], is_left[keep]
    common = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(shared.sum()), 4096):
        inside = (rank >= low) & (rank < low + 4096)
        sides = []
        for chosen, n in ((is_left, len(left)), (~is_left, len(right))):
            has = np.zeros((n, 4096), np.float32)
            at = inside & chosen
            has[place[owner[at]], rank[at] - low] = 1
            sides.append(has)
        common += sides[0] @ sides[1].T
    common = common.astype(np.int64)
    a, b = np.nonzero(linked(common, size[left][:, None], size[right][None, :]) & (root[left][:, None] != root[right][None, :]))
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x] = parent.get(parent[x], parent[x])
        return x

    out = []
    for x, y in np.unique(np.stack([root[left][a], root[right][b]], 1), axis=0).tolist():
        if top(x) != top(y):
            parent[top(x)] = top(y)
            out.append((x, y))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def node_links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, root for every node that is linked with another. Each table is deleted once its last reader is done."""
    banded = nodes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min(F.struct("node", "n_shingles")).alias("center"), F.bit_xor(F.xxhash64("node")).alias("members"),
    ).filter("n > 1")
    # Buckets with the same members, as bands of near copies mostly are, count once.
    buckets = materialize(buckets.groupBy("n", "center", "members").agg(F.min("bucket").alias("bucket")).drop("members"), "buckets")
    # Most bands are alone in their bucket and are left out before the shuffle.
    shared = may_match(banded, "bucket", buckets.select(F.col("bucket").alias("_bucket")), "_bucket")
    members = materialize(
        join_counted(shared, buckets, "bucket", "n", total(buckets, "n"))
        .select("bucket", "n", "node", "n_shingles", F.col("center.node").alias("center"), F.col("center.n_shingles").alias("center_size")),
        "members")
    discard(buckets)
    involved = materialize(members.select("node").distinct().join(nodes.select("node", "rep"), "node").select("node", "rep.*"), "involved")
    sets = materialize(sets_of(docs, involved), "sets")
    discard(involved)

    pairs = members.filter("node != center and 100 * least(n_shingles, center_size) >= 75 * greatest(n_shingles, center_size)")
    common = F.size(F.array_intersect("shingles", "center_shingles"))
    stars = materialize(
        pairs.select("node", "center").distinct().join(sets_among(sets, pairs, "node"), "node")
        .join(sets_among(sets, pairs, "center").select(F.col("node").alias("center"), F.col("shingles").alias("center_shingles")), "center")
        .filter(linked(common, F.size("shingles"), F.size("center_shingles")))
        .select(F.col("node").alias("a"), F.col("center").alias("b")), "stars")
    roots = materialize(components(stars), "roots")
    discard(stars)

    placed = materialize(
        members.filter("node != center").join(roots, "node", "left")
        .select("bucket", "node", "n_shingles", F.coalesce("root", "node").alias("root")), "placed")
    discard(members)
    per_root = placed.groupBy("bucket", "root").agg(F.count("*").alias("k"), F.sum("n_shingles").alias("w"))
    mixed = per_root.groupBy("bucket").agg(
        F.max(F.struct("k", "root")).alias("main"), F.count("*").alias("roots"), F.sum("k").alias("n"), F.sum("w").alias("w"),
        F.max(F.struct("k", "w")).alias("most")).filter("roots > 1")
    cuts = lambda n, w: F.ceil(F.greatest(n / BLOCK_NODES, w / BLOCK_SHINGLES)).cast("int")
    mixed = materialize(mixed.select(
        "bucket", "n", F.col("main.root").alias("main"),
        cuts(F.col("n") - F.col("most.k"), F.col("w") - F.col("most.w")).alias("high"), cuts(F.col("n"), F.col("w")).alias("wide")), "mixed")
    around = materialize(join_counted(placed, mixed, "bucket", "n", total(mixed, "n")), "around")
    discard(placed, mixed)
    block = lambda parts: F.pmod(F.xxhash64("node"), parts).cast("int")
    one_side = around.filter("root != main").select(
        "bucket", F.lit(0).alias("side"), "node", "root", block(F.col("high")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("j"))
    other_side = around.select(
        "bucket", F.lit(1).alias("side"), "node", "root", F.explode(F.sequence(F.lit(0), F.col("high") - 1)).alias("i"), block(F.col("wide")).alias("j"))
    rest = materialize(
        one_side.unionByName(other_side).join(sets_among(sets, around, "node"), "node").groupBy("bucket", "i", "j").applyInArrow(block_links, "a long, b long"), "rest")
    discard(around, sets)
    above = materialize(components(rest), "above")
    counted = above.withColumn("n", F.lit(1).cast("long")).select(F.col("node").alias("root"), F.col("root").alias("above"))
    joined = roots.join(counted, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    # Nodes that only the second comparison linked.
    found = materialize(joined.unionByName(above.join(roots.select("node"), "node", "left_anti")), "components")
    discard(roots, rest, above)
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id (smallest doc_id reachable by links), kept: one row per row of `docs`.

    Linked are documents whose sets of distinct 5-word shingles, lower-cased, have a similarity of 0.75 or more. A shorter text
    has its word sequence as its one shingle; a text without words is linked with nothing and kept. Null ids don't count as
    smallest; if a component has no other, its component_id is null. An empty table gives no rows; other columns aren't read.
    """
    sketched = materialize(sketch(docs), "sketch")
    nodes = materialize(
        sketched.filter("n_shingles > 0").groupBy("set_key").agg(
            F.min("doc_id").alias("least"), F.count("*").alias("n_docs"), F.first("n_shingles").alias("n_shingles"),
            F.min(F.struct("doc_id", "text_key")).alias("rep"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    rows = materialize(sketched.select("doc_id", "text_key", "n_shingles", "set_key"), "rows")
    discard(sketched)
    roots = node_links(docs, nodes)
    whole = nodes.select("node", "set_key", "least", "n_docs").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = whole.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n_nodes"))
    named = join_counted(whole, lowest, "root", "n_nodes", total(lowest, "n_nodes"))
    sets = materialize(named.select("set_key", "n_docs", "component_id"), "named")
    discard(nodes, roots)
    found = join_counted(rows.filter("n_shingles > 0"), sets, "set_key", "n_docs", total(sets, "n_docs"))
    alone = rows.filter("n_shingles = 0").withColumns({"n_docs": F.lit(1).cast("long"), "component_id": F.col("doc_id")})
    return found.unionByName(alone).select(
        "doc_id", "text_key", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    gone = materialize(
        near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "gone")
    key = F.xxhash64("__row.text")
    return unpacked(packed(docs).join(
        gone, F.col("__row.doc_id").cast("long").eqNullSafe(F.col("__id")) & (key == F.col("__key")), "left_anti"))
