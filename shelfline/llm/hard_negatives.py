"""Hard negatives by a multiway hyperplane tree.

Each inner node of the tree has split points; a vector goes to the nearest one's subtree, so the borders between siblings are
hyperplanes. For every split point and every sibling subtree the node keeps the range of the distances between them. A search
wants the vectors in an annulus around its anchor; where the distance to a split point leaves no room for a vector of a
subtree that is both in the annulus and in the range, the subtree is eliminated, by each split point for all siblings.

The split points come from a bounded seeded sample. All rows are then assigned and all ranges taken over all rows, so the
search is exact. A leaf is scanned in blocks of bounded size, anchors come in chunks of bounded size, and each pair of them is
one group, whose scores are one product of whole-numbered matrices. Searches go in three steps: an anchor's own block gives a
first bound for its positives; the leaves that this bound leaves over give the positives; the leaves that meet the window of
scores below one of the positives give its negatives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.text import prepare
from shelfline.llm.vectors import matrix, usable, whole_numbers
from shelfline.session import materialize

SAMPLE = 4096
"""Rows that the split points are chosen from, a seeded sample if there are more; every row is indexed."""
BRANCHES, LEAF_ROWS, LEAST_SAMPLE = 8, 2048, 32
BLOCK, CHUNK, TILE = 4096, 2048, 256
BOUND = float(1 << 27)
_EXACT = float(1 << 52)


@dataclass
class Node:
    """Split points, and per branch the number of its node (0 and up) or leaf (-1 and down); ranges are filled in later."""

    points: np.ndarray
    branches: list[int] = field(default_factory=list)


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=list)
    leaves: int = 0
    #: Per node: least and largest distance of split point i to the vectors of branch j, and of their squared lengths.
    near: list[np.ndarray] = field(default_factory=list)
    far: list[np.ndarray] = field(default_factory=list)
    short: list[np.ndarray] = field(default_factory=list)
    long: list[np.ndarray] = field(default_factory=list)


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = (rows**2).sum(1)[:, None] + (points**2).sum(1)[None, :] - 2 * rows @ points.T
    return np.sqrt(np.maximum(squares, 0))


def spread_points(rows: np.ndarray, number: int) -> np.ndarray:
    """Rows far from each other: each next one has the largest distance to the nearest of those before."""
    chosen = [0]
    gap = distances(rows, rows[:1])[:, 0]
    while len(chosen) < number and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def grow(sample: np.ndarray, rows: int, leaf_rows: int = LEAF_ROWS, branches: int = BRANCHES) -> Tree:
    """The tree over a sample of `rows` rows. Its size is bounded by the sample's."""
    tree = Tree()

    def build(part: np.ndarray) -> int:
        points = part[:0]
        if len(part) >= LEAST_SAMPLE and len(part) * rows / len(sample) > leaf_rows:
            points = spread_points(part[:: max(1, len(part) // (3 * branches))], branches)
        if len(points) < 2:
            tree.leaves += 1
            return -tree.leaves
        at = len(tree.nodes)
        tree.nodes.append(Node(points))
        nearest = distances(part, points).argmin(1)
        tree.nodes[at].branches = [build(part[nearest == j]) for j in range(len(points))]
        return at

    build(sample)
    return tree


def routes(tree: Tree, rows: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The leaf (from 0) of every row; and per node: its number, the rows that pass it, their distances, their branches."""
    leaf = np.zeros(len(rows), np.int32)
    steps, waiting = [], [(0, np.arange(len(rows)))] if tree.nodes else []
    while waiting:
        at, some = waiting.pop()
        node = tree.nodes[at]
        apart = distances(rows[some], node.points)
        branch = apart.argmin(1)
        steps.append((at, some, apart, branch))
        for j, to in enumerate(node.branches):
            own = some[branch == j]
            if to < 0:
                leaf[own] = -to - 1
            elif len(own):
                waiting.append((to, own))
    return leaf, steps


def measure(tree: Tree, placed: DataFrame, width: int) -> None:
    """Fills the tree's ranges from all rows. What comes to the driver has the size of the tree."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[tuple[int, int, int], list[float]] = {}
        for batch in batches:
            rows = matrix(batch.column("y"), width).astype(np.float64)
            squares = (rows**2).sum(1)
            for at, some, apart, branch in routes(tree, rows)[1]:
                for j in np.unique(branch):
                    own = branch == j
                    low, high = apart[own].min(0), apart[own].max(0)
                    short, long = squares[some[own]].min(), squares[some[own]].max()
                    for i in range(len(low)):
                        was = out.get((at, i, int(j)), [np.inf, 0.0, np.inf, 0.0])
                        out[at, i, int(j)] = [min(was[0], low[i]), max(was[1], high[i]), min(was[2], short), max(was[3], long)]
        keys, values = np.array(list(out), np.int32).reshape(-1, 3), np.array(list(out.values())).reshape(-1, 4)
        yield pa.record_batch(
            {c: pa.array(keys[:, k]) for k, c in enumerate(("node", "i", "j"))}
            | {c: pa.array(values[:, k]) for k, c in enumerate(("near", "far", "short", "long"))})

    found = placed.select("y").mapInArrow(
        work, "node int, i int, j int, near double, far double, short double, long double").groupBy("node", "i", "j").agg(
        F.min("near").alias("near"), F.max("far").alias("far"), F.min("short").alias("short"), F.max("long").alias("long"))
    sizes = [len(node.points) for node in tree.nodes]
    # A branch that no row has taken keeps a range that nothing meets.
    tree.near, tree.far = [np.full((m, m), np.inf) for m in sizes], [np.full((m, m), -np.inf) for m in sizes]
    tree.short, tree.long = [np.full(m, np.inf) for m in sizes], [np.full(m, -np.inf) for m in sizes]
    for r in found.collect():
        tree.near[r["node"]][r["i"], r["j"]], tree.far[r["node"]][r["i"], r["j"]] = r["near"], r["far"]
        tree.short[r["node"]][r["j"]], tree.long[r["node"]][r["j"]] = r["short"], r["long"]


def survivors(tree: Tree, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, leaf) such that the leaf may hold a vector whose product with the anchor is in [low, high]."""
    if not tree.nodes:
        return np.arange(len(anchors)), np.zeros(len(anchors), np.int32)
    squares = (anchors**2).sum(1)
    who, where, waiting = [], [], [(0, np.arange(len(anchors)))]
    with np.errstate(invalid="ignore"):
        while waiting:
            at, some = waiting.pop()
            node, near, far = tree.nodes[at], tree.near[at], tree.far[at]
            apart = distances(anchors[some], node.points)
            slack = 1e-6 * (1 + apart.max(1))
            for j, to in enumerate(node.branches):
                if tree.short[at][j] > tree.long[at][j]:
                    continue
                # The annulus: |q - x|^2 = |q|^2 + |x|^2 - 2 q.x, with what is known of |x| in this branch.
                inner = np.sqrt(np.maximum(squares[some] + tree.short[at][j] - 2 * high[some], 0)) - slack
                outer = np.sqrt(np.maximum(squares[some] + tree.long[at][j] - 2 * low[some], 0)) + slack
                closest = np.maximum(apart - far[:, j], near[:, j] - apart).max(1)
                furthest = (apart + far[:, j]).min(1)
                own = some[(closest <= outer) & (furthest >= inner)]
                if to < 0:
                    who.append(own)
                    where.append(np.full(len(own), -to - 1, np.int32))
                elif len(own):
                    waiting.append((to, own))
    return np.concatenate([np.zeros(0, np.int64), *who]), np.concatenate([np.zeros(0, np.int32), *where])


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered vectors: by floating point where every partial sum is exact, else in 64 bits."""
    most = lambda x: np.sqrt((x.astype(np.float64) ** 2).sum(1).max(initial=0))
    if most(anchors) * most(rows) < _EXACT:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return anchors.astype(np.int64) @ rows.astype(np.int64).T


def best(scores: np.ndarray, allowed: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (line, column) of the `number` largest allowed scores of each line; of equal ones the first columns."""
    least = np.iinfo(np.int64).min
    masked = np.where(allowed, scores, least)
    if masked.shape[1] > number:
        edge = np.partition(masked, masked.shape[1] - number, axis=1)[:, -number]
        masked = np.where(masked >= edge[:, None], masked, least)
    line, place = np.nonzero(masked > least)
    order = np.lexsort((place, -masked[line, place], line))
    line, place = line[order], place[order]
    first = np.searchsorted(line, np.arange(len(scores)))
    keep = np.arange(len(line)) - first[line] < number
    return line[keep], place[keep]


class Block:
    """Rows of one block, by vec_id, as columns."""

    def __init__(self, rows: pa.Table, width: int):
        rows = rows.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        self.row, self.vec_id, self.label = (rows.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.y = matrix(rows.column("y"), width)


FOUND = "anchor long, positive long, row long, vec_id long, score long"
_FOUND_TYPES = {c.split()[0]: pa.int64() for c in FOUND.split(", ")}


def found_table(anchor: np.ndarray, positive: np.ndarray, block: Block, place: np.ndarray, score: np.ndarray) -> pa.Table:
    values = (anchor, positive, block.row[place], block.vec_id[place], score)
    return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(_FOUND_TYPES, values, strict=True)})


def nothing() -> pa.Table:
    return pa.table({c: pa.array([], t) for c, t in _FOUND_TYPES.items()})


def search_positives(anchors: pa.Table, rows: pa.Table, width: int, number: int) -> pa.Table:
    """Each anchor's `number` best other rows of its label in one block."""
    block, parts = Block(rows, width), []
    y, name, label = matrix(anchors.column("y"), width), anchors.column("anchor").to_numpy(), anchors.column("label").to_numpy()
    for at in range(0, len(y), TILE):
        scores = products(y[at : at + TILE], block.y)
        allowed = (label[at : at + TILE, None] == block.label) & (name[at : at + TILE, None] != block.row)
        line, place = best(scores, allowed, number)
        parts.append(found_table(name[line + at], np.full(len(line), -1), block, place, scores[line, place]))
    return pa.concat_tables(parts)


def search_negatives(anchors: pa.Table, rows: pa.Table, width: int, number: int, low: int) -> pa.Table:
    """For each anchor and each of its positives, the `number` best rows of other labels in the window under the positive."""
    block, parts = Block(rows, width), []
    y, name, label = matrix(anchors.column("y"), width), anchors.column("anchor").to_numpy(), anchors.column("label").to_numpy()
    part, whole = low // gcd(low, 100), 100 // gcd(low, 100)
    bounds = anchors.column("scores").combine_chunks()
    first, bounds = bounds.offsets.to_numpy(), bounds.values.to_numpy()
    for at in range(0, len(y), TILE):
        scores = products(y[at : at + TILE], block.y)
        other = label[at : at + TILE, None] != block.label
        own = np.diff(first[at : at + TILE + 1])
        for k in range(int(own.max(initial=0))):
            has = np.flatnonzero(own > k)
            bound = bounds[first[at + has] + k][:, None]
            mine = scores[has]
            line, place = best(mine, other[has] & (mine <= bound) & (whole * mine >= part * bound), number)
            parts.append(found_table(name[has[line] + at], np.full(len(line), k), block, place, mine[line, place]))
    return pa.concat_tables([nothing(), *parts])


def visits(anchors: DataFrame, tree: Tree, width: int, windows: str) -> DataFrame:
    """The anchors' rows, each once for every leaf that survives for one of its windows. `windows`: a column of arrays of
    {low, high}."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = matrix(batch.column("y"), width).astype(np.float64)
            each = batch.column(windows)
            first, pairs = each.offsets.to_numpy(), each.values
            who = np.repeat(np.arange(len(y)), np.diff(first))
            low, high = (pairs.field(c).to_numpy(zero_copy_only=False)[first[0] : first[-1]] for c in ("low", "high"))
            line, leaf = survivors(tree, y[who], low, high)
            pair = np.unique(who[line] * max(1, tree.leaves) + leaf)
            yield pa.RecordBatch.from_arrays(
                [*batch.take(pa.array(pair // max(1, tree.leaves))).columns, pa.array((pair % max(1, tree.leaves)).astype(np.int32))],
                names=[*batch.schema.names, "leaf"])

    kinds = ", ".join(f"{c} {t}" for c, t in anchors.dtypes)
    return anchors.mapInArrow(work, f"{kinds}, leaf int")


def scan(visiting: DataFrame, placed: DataFrame, leaves: DataFrame, search) -> DataFrame:
    """`search` over every pair of a leaf's block and a chunk of the anchors that visit the leaf."""
    visiting = materialize(visiting, "visits")
    # One row per leaf, and no more leaves than the sample has rows.
    chunks = F.broadcast(visiting.groupBy("leaf").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")).join(leaves, "leaf"))
    left = visiting.join(chunks, "leaf").withColumn("chunk", F.pmod(F.xxhash64("anchor"), "chunks").cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("chunks", "blocks")
    right = placed.join(chunks, "leaf").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "leaf", "block", "chunk", "row", "vec_id", "label", "y")

    return met(left, right, ["leaf", "block", "chunk"], search)


def met(anchors: DataFrame, rows: DataFrame, keys: list[str], search) -> DataFrame:
    def both(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        return search(anchors, rows) if anchors.num_rows and rows.num_rows else nothing()

    # Both sides come from one table; only columns of its own give a side all that it has.
    rows = rows.select(*(F.col(c).alias(c) for c in rows.columns))
    return anchors.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(both, FOUND)


def first_of(found: DataFrame, keys: list[str], number: int) -> DataFrame:
    """The first `number` of each group: higher scores first, then smaller vec_id. Each block has given out `number` at most."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= number)


def mine(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and positive the first
    `negatives` rows of other labels whose score is between `low` percent of the positive's and the positive's.

    Anchors are the rows whose vec_id is divisible by `every`. A score is the inner product of floor(scale * entry), which ends
    at 2^27 on both sides; products are exact up to 256 entries of that size. An anchor's positives are its first `positives`
    other rows of the same label. Rows without vec_id, label or usable vector (`vectors.usable`) take no part. Repeated rows are
    rows of their own: an anchor's copy can be its positive, and copies of an anchor each get their rows. Without anchors,
    positives or negatives there are no rows. Other columns are not read.
    """
    spark = rows.sparkSession
    prepare(spark)
    given = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    found, width = usable(given.filter("vec_id IS NOT NULL AND label IS NOT NULL"))
    whole = materialize(found.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label",
        whole_numbers("embedding", scale, BOUND).cast("array<int>").alias("y")), "whole_vectors")
    total = whole.count()
    share = SAMPLE / max(SAMPLE, total)
    # The row number is part of the seed, so copies of one vector don't come in all together; 2 x SAMPLE is never reached in practice.
    sample = whole.filter(F.pmod(F.xxhash64("row", F.lit(29)), F.lit(1 << 30)) < share * (1 << 30)).select("y").limit(2 * SAMPLE)
    tree = grow(matrix(sample.toArrow().column("y"), width).astype(np.float64) if total else np.zeros((0, 1)), total)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = routes(tree, matrix(batch.column("y"), width).astype(np.float64))[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    placed = whole.mapInArrow(place, "row long, vec_id long, label long, y array<int>, leaf int") if total else whole.withColumn("leaf", F.lit(0))
    leaves = placed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    leaves = materialize(leaves, "leaves")
    placed = materialize(
        placed.join(F.broadcast(leaves), "leaf").withColumn("block", F.pmod(F.xxhash64("row"), "blocks").cast("int")).drop("blocks"), "placed")
    if total:
        measure(tree, placed, width)

    # An anchor's own block gives a first bound.
    anchors = placed.filter(F.col("vec_id") % every == 0).select(
        F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "y", "leaf", "block")

    near_by = lambda anchors, rows: search_positives(anchors, rows, width, positives)
    close = met(anchors, placed.select("leaf", "block", "row", "vec_id", "label", "y"), ["leaf", "block"], near_by)
    bound = close.groupBy("anchor").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    open_end = 1e18
    windows = materialize(anchors.drop("leaf", "block").join(bound, "anchor", "left").withColumn("windows", F.array(F.struct(
        F.when(F.col("n") >= positives, F.col("least").cast("double")).otherwise(-open_end).alias("low"),
        F.lit(open_end).alias("high")))).drop("n", "least"), "anchors")
    first = first_of(scan(visits(windows, tree, width, "windows"), placed, leaves, near_by), ["anchor"], positives)
    chosen = materialize(first.select("anchor", "place", "vec_id", "score"), "positives")
    grouped = chosen.groupBy("anchor").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "score"))), lambda p: p["score"]).alias("scores"))
    grouped = grouped.join(windows.drop("windows"), "anchor").withColumn("windows", F.transform(
        F.filter("scores", lambda s: s >= 0), lambda s: F.struct((s * low / 100.0).alias("low"), s.cast("double").alias("high"))))
    found = scan(visits(grouped, tree, width, "windows"), placed, leaves,
                 lambda anchors, rows: search_negatives(anchors, rows, width, negatives, low))
    last = first_of(found, ["anchor", "positive"], negatives)
    pairs = chosen.join(windows.select("anchor", "anchor_id"), "anchor").select(
        "anchor", "anchor_id", (F.col("place") - 1).cast("long").alias("positive"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"))
    return last.join(pairs, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
