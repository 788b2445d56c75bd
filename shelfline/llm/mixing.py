"""Mixing sources to target weights by a minimum-cost flow.

A text can stand in several sources. Documents are added up by membership pattern (the set of sources that hold their text)
and source; words flow from patterns to the sources' quotas. What a pattern gives beyond its distinct words repeats texts,
and each further repetition costs more, so the flow draws on the sources' own texts before it repeats shared ones. Costs lie
only on what patterns give, so raising the flow level by level of cost, to its maximum in each, gives the cheapest flow.
Within each pattern and source documents are then taken in seeded order, as often as the flow says.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.joins import join_counted, packed, total, unpacked
from shelfline.llm.text import blocks, column, prepare
from shelfline.session import discard, materialize

MOST, SEED, BIN_BITS = 3, 17, 10
NEAR, ROUNDS = 0.002, 8


def targets(sizes: list[int]) -> list[float]:
    """Weights 1, 2, 3, repeating, over all words; a target stops at MOST times its source, the rest goes to the others."""
    weight = [1 + i % 3 for i in range(len(sizes))]
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        whole = sum(weight[i] for i in open_)
        over = [i for i in open_ if left * weight[i] / whole > MOST * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weight[i] / whole
            break
        for i in over:
            out[i] = float(MOST * sizes[i])
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


class Network:
    """Maximum flow by shortest augmenting paths in layers; capacities can be raised between calls."""

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def arc(self, a: int, b: int, room: int) -> int:
        self.arcs[a].append(len(self.to))
        self.arcs[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [room, 0]
        return len(self.to) - 2

    def fill(self, start: int, end: int) -> None:
        while True:
            level = [-1] * len(self.arcs)
            level[start] = 0
            queue = deque([start])
            while queue:
                a = queue.popleft()
                for e in self.arcs[a]:
                    if self.room[e] and level[self.to[e]] < 0:
                        level[self.to[e]] = level[a] + 1
                        queue.append(self.to[e])
            if level[end] < 0:
                return
            tried = [0] * len(self.arcs)
            while self._push(start, end, level, tried):
                pass

    def _push(self, start: int, end: int, level: list[int], tried: list[int]) -> int:
        path, a = [], start
        while a != end:
            while tried[a] < len(self.arcs[a]):
                e = self.arcs[a][tried[a]]
                if self.room[e] and level[self.to[e]] == level[a] + 1:
                    break
                tried[a] += 1
            else:
                if not path:
                    return 0
                e = path.pop()
                a = self.to[e ^ 1]
                tried[a] += 1
                continue
            path.append(e)
            a = self.to[e]
        much = min(self.room[e] for e in path)
        for e in path:
            self.room[e] -= much
            self.room[e ^ 1] += much
        return much


def route(cells: dict[tuple[str, int], int], distinct: dict[str, int], quotas: list[int]) -> dict[tuple[str, int], int]:
    """Words that each (pattern, source) gives. `cells`: words of its documents; `distinct`: a pattern's words without copies.

    A pattern gives its distinct words free, as many again at cost 1, twice as many at cost 2, four times as many at cost 4
    and so on; a document gives itself MOST times at most.
    """
    patterns = sorted(distinct)
    place = {p: 1 + i for i, p in enumerate(patterns)}
    end = 1 + len(patterns) + len(quotas)
    net = Network(end + 1)
    arcs = {(p, s): net.arc(place[p], 1 + len(patterns) + s, MOST * words) for (p, s), words in cells.items()}
    for s, quota in enumerate(quotas):
        net.arc(1 + len(patterns) + s, end, quota)
    supply = {p: net.arc(0, place[p], 0) for p in patterns}
    whole = Counter()
    for (p, _), words in cells.items():
        whole[p] += words
    most = max((MOST * whole[p] / max(1, distinct[p]) for p in patterns), default=0)
    given = 0
    while given < most:
        for p in patterns:
            net.room[supply[p]] += distinct[p] * max(1, given)
        net.fill(0, end)
        given += max(1, given)
    return {cell: net.room[e ^ 1] for cell, e in arcs.items()}


def order(seed: int) -> Column:
    return F.xxhash64("doc_id", "digest", F.lit(seed))


def take(rows: DataFrame, group: str, quotas: DataFrame, seed: int, wanted: Column) -> DataFrame:
    """Adds `chosen`: the `wanted` rows of each group in seeded order while their sizes add up to no more than its quota.

    The order's leading bits make bins. Whole bins below the group's last one are chosen by their totals; only the rows of the
    last bin, one in a thousand, are ordered. `quotas`: one row per group, with `quota`, the group's number of rows `_rows`, and
    columns that its rows get.
    """
    keyed = rows.withColumns({"_h": order(seed), "_wanted": wanted}).withColumn("_bin", F.shiftrightunsigned("_h", 64 - BIN_BITS))
    bins = keyed.filter("_wanted").groupBy(group, "_bin").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy(group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        bins.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0))).join(quotas, group)
        .filter(F.col("_before") + F.col("_words") > F.col("quota"))
        .groupBy(group).agg(F.min(F.struct("_bin", "_before", "quota")).alias("_last")))
    # There can be as many groups as the table has texts in several sources: only those with many rows are broadcast.
    ends = materialize(quotas.drop("quota").join(last, group, "left"), "ends")
    placed = join_counted(keyed, ends, group, "_rows", total(ends, "_rows"))
    at_last = F.coalesce(F.col("_bin") == F.col("_last._bin"), F.lit(False)) & F.col("_wanted")
    running = Window.partitionBy(group).orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = placed.filter(at_last).withColumn("chosen", F.sum("size").over(running) + F.col("_last._before") <= F.col("_last.quota"))
    whole = placed.filter(~at_last).withColumn(
        "chosen", F.col("_wanted") & (F.col("_last").isNull() | (F.col("_bin") < F.col("_last._bin"))))
    columns = [*rows.columns, *(c for c in quotas.columns if c not in (group, "quota", "_rows")), "chosen"]
    return edge.select(columns).unionByName(whole.select(columns))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, digest (of the text), size (words)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                yield pa.record_batch(
                    {c: batch.column(c).slice(block.first, block.n) for c in ("doc_id", "source", "digest")}
                    | {"size": column(np.diff(block.words()[2]).astype(np.int64))})

    prepare(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), digest().alias("digest"), "text").mapInArrow(
        work, "doc_id long, source string, digest binary, size long")


def digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, source, digest, size, source_size, target, taken: one row per row of `docs`.

    Sources in code point order, null last, have the weights 1, 2, 3, repeating. `taken` is 0 or a multiple of the size up to
    MOST. A source of empty texts has the target 0. Equal ids and texts are ordered alike, so reruns agree. Other columns are
    not read. The driver holds one row per source and one per pattern and source, never documents.
    """
    spark = docs.sparkSession
    base = materialize(measured(docs), "sized")
    found = sorted(base.groupBy("source").agg(F.sum("size").alias("w")).collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["w"] for r in found]
    goals = targets(sizes)
    if not found:
        return base.withColumns({"source_size": F.lit(0).cast("long"), "target": F.lit(0.0), "taken": F.lit(0).cast("long")})
    names = spark.createDataFrame(
        [(r["source"], i, sizes[i], goals[i]) for i, r in enumerate(found)], "_name string, s int, source_size long, target double")
    rows = base.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("_name"))).drop("_name")

    # Which sources hold a text.
    shared = materialize(
        rows.groupBy("digest").agg(F.sort_array(F.collect_set("s")).alias("p"), F.count("*").alias("n"), F.first("size").alias("one"))
        .withColumn("p", F.concat_ws(",", "p")), "shared")
    distinct = {r["p"]: r["words"] for r in shared.groupBy("p").agg(F.sum("one").alias("words")).collect()}
    rows = materialize(join_counted(rows, shared, "digest", "n", total(shared, "n")).drop("n", "one")
                       .withColumn("cell", F.concat_ws("|", "p", "s")), "cells")
    discard(base, shared)
    held = rows.groupBy("p", "s").agg(F.sum("size").alias("w"), F.count("*").alias("n")).collect()
    cells = {(r["p"], r["s"]): r["w"] for r in held}
    flow = route(cells, distinct, [round(g) for g in goals])

    whole = materialize(spark.createDataFrame(
        [(f"{r['p']}|{r['s']}", *(divmod(flow[r["p"], r["s"]], r["w"]) if r["w"] else (0, 0)), r["n"]) for r in held],
        "cell string, times long, quota long, _rows long"), "quotas")
    some = F.col("size") > 0
    picked = take(rows.drop("p"), "cell", whole, SEED, some)
    cellwise, rows = rows, materialize(
        picked.withColumn("n", F.col("times") + F.col("chosen").cast("long")).drop("times", "chosen", "cell"), "picked")
    discard(cellwise, whole)
    for turn in range(ROUNDS):
        now = rows.groupBy("s").agg(F.sum(F.col("n") * F.col("size")).alias("w"), F.count("*").alias("rows")).collect()
        gaps = [(r["s"], round(goals[r["s"]]) - r["w"], r["rows"]) for r in now]
        gaps = [(s, g if g > NEAR * goals[s] else 0, n) for s, g, n in gaps]
        if not any(g for _, g, _ in gaps):
            break
        left = spark.createDataFrame(gaps, "s int, quota long, _rows long")
        fits = rows.join(F.broadcast(left.select("s", F.col("quota").alias("_gap"))), "s")
        more = take(fits, "s", left, SEED + 1 + turn, some & (F.col("size") <= F.col("_gap")) & (F.col("n") < MOST))
        before, rows = rows, materialize(more.withColumn("n", F.col("n") + F.col("chosen").cast("long")).drop("chosen", "_gap"), "filled")
        discard(before)
    return rows.select("doc_id", "source", "digest", "size", "source_size", "target", (F.col("n") * F.col("size")).alias("taken"))


def repeat(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of `docs` as often as it is taken. Of repeated rows each counts as the one taken most."""
    plan = mixed(docs).filter("taken > 0").groupBy("doc_id", "source", "digest").agg(F.max(F.expr("taken div size")).alias("__times"))
    plan = materialize(plan.withColumnsRenamed({"doc_id": "__id", "source": "__source", "digest": "__text"}), "plan")
    same = (
        F.col("__row.doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__text"))
        & F.col("__row.source").cast("string").eqNullSafe(F.col("__source")))
    found = packed(docs).withColumn("__digest", digest("__row.text")).join(plan, same)
    return unpacked(found.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int")))))
