"""A classifier chain over toxicity categories.

The categories are predicted one after the other; each linear model sees the features of the text and the probabilities of
all earlier categories. In training those probabilities come out of fold: from models whose features and weights have not
seen the labels of the document's fold. All models of a category are fitted together by Newton steps, one aggregate a step.
Features are the letter runs of the text, lower-cased, and their five-byte beginnings, the ones that tell the categories apart
best on the labelled documents, as log counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from shelfline.llm.text import Block, blocks, column, distinct, prepare, span_hash
from shelfline.session import discard, materialize

TRAINING_ROWS = 20_000
"""Bound on the labelled documents that are fitted, a seeded sample if there are more."""
FEATURES, FOLDS, THRESHOLD, BEGINNING = 256, 3, 0.5, 5
PENALTY, PASSES, TASKS = 1e-3, 60, 8


def keys_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's letter runs and of the beginnings of its longer ones, and where each text's begin."""
    low = block.data | 32
    starts, ends, first = block.spans(((low >= 97) & (low <= 122)) | (block.data >= 128))
    prefix = block.prefix(lower=True)
    longer = ends - starts > BEGINNING
    runs = span_hash(prefix, starts, ends)
    heads = span_hash(prefix, starts[longer], starts[longer] + BEGINNING) ^ np.uint64(0xA0761D6478BD642F)
    owner = np.repeat(np.arange(block.n), np.diff(first))
    both = np.concatenate([owner, owner[longer]])
    order = np.argsort(both, kind="stable")
    return np.concatenate([runs, heads])[order], np.searchsorted(both[order], np.arange(block.n + 1))


def counts_of(block: Block, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which text has which of the (sorted) chosen features how often."""
    keys, first = keys_of(block)
    at = np.minimum(np.searchsorted(chosen, keys), max(0, len(chosen) - 1))
    hit = np.flatnonzero(chosen[at] == keys) if len(chosen) else np.zeros(0, np.int64)
    owner = np.searchsorted(first, hit, side="right") - 1
    pairs, times = np.unique(owner * max(1, len(chosen)) + at[hit], return_counts=True)
    return pairs // max(1, len(chosen)), pairs % max(1, len(chosen)), times


def occurrences(texts: DataFrame, marks: list[str]) -> DataFrame:
    """key; how many labelled documents have it (`n`), how many of them have each mark, and the same inside each fold (`n_0`, ...)."""
    sums = ["n", *marks]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            of = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in marks}
            for block in blocks(batch):
                keys, _, first = distinct(*keys_of(block))
                owner = np.repeat(np.arange(block.n), np.diff(first)) + block.first
                names, which = np.unique(keys, return_inverse=True)
                pairs, which = np.unique(which * FOLDS + fold[owner], return_inverse=True)
                yield pa.record_batch(
                    {"key": column(names[pairs // FOLDS]), "fold": column(pairs % FOLDS),
                     "n": column(np.bincount(which, minlength=len(pairs)).astype(np.int64))}
                    | {c: column(np.bincount(which, of[c][owner], len(pairs)).astype(np.int64)) for c in marks})

    found = texts.select("text", "fold", *marks).mapInArrow(work, "key long, fold long, " + ", ".join(f"{c} long" for c in sums))
    return found.groupBy("key").agg(*(F.sum(c).alias(c) for c in sums), *(
        F.sum(F.when(F.col("fold") == m, F.col(c)).otherwise(0)).alias(f"{c}_{m}") for c in sums for m in range(FOLDS)))


def choose(found: DataFrame, total: Row, marks: list[str], without: int | None = None) -> list[int]:
    """The FEATURES keys whose document frequency differs most between a mark and the rest, in standard errors; counted on all
    labelled documents or on those outside the fold `without`."""

    def n_of(c: str) -> Column:
        return F.col(c) if without is None else F.col(c) - F.col(f"{c}_{without}")

    def all_of(c: str) -> int:
        return total[c] - (0 if without is None else total[f"{c}_{without}"])

    best: list[int] = []
    seen = found.filter(n_of("n") >= 3)
    for c in marks:
        share, rest = (n_of(c) + 0.5) / (all_of(c) + 1), (n_of("n") - n_of(c) + 0.5) / (all_of("n") - all_of(c) + 1)
        pooled = (n_of("n") + 1) / (all_of("n") + 2)
        apart = F.abs(share - rest) / F.sqrt(pooled * (1 - pooled / 2))
        best += [r["key"] for r in seen.orderBy(F.desc(apart), "key").limit(FEATURES // len(marks)).select("key").collect()]
    return best


def vectors(texts: DataFrame, chosen: np.ndarray, kept: list[str]) -> DataFrame:
    """The kept columns, the places of the chosen features that a text has (`at`), and their log counts (`x`)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                owner, feature, times = counts_of(block, chosen)
                bounds = column(np.searchsorted(owner, np.arange(block.n + 1)).astype(np.int32))
                yield pa.record_batch(
                    {c: batch.column(c).slice(block.first, block.n) for c in kept}
                    | {"at": pa.ListArray.from_arrays(bounds, column(feature.astype(np.int32))),
                       "x": pa.ListArray.from_arrays(bounds, column(np.log1p(times)))})

    return texts.select(*kept, "text").mapInArrow(work, ", ".join(f"{c} long" for c in kept) + ", at array<int>, x array<double>")


def dense(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors of a batch as a matrix."""
    out = np.zeros((batch.num_rows, width))
    owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("at")).to_numpy())
    out[owner, batch.column("at").flatten().to_numpy()] = batch.column("x").flatten().to_numpy()
    return out


def chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def seen_by(x: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """What a model reads: a one for its intercept, its features, the probabilities of earlier categories."""
    return np.concatenate([np.ones((len(x), 1)), x, earlier], 1)


def out_of_fold(x: np.ndarray, fold: np.ndarray, places: list[np.ndarray], fitted: list[list[np.ndarray]]) -> np.ndarray:
    """For each row the probabilities of the categories fitted so far, from the models that have not seen the row's fold."""
    out = np.zeros((len(x), len(fitted)))
    for k, of in enumerate(fitted):
        for m in range(FOLDS):
            own = fold == m
            out[own, k] = chance(seen_by(x[own][:, places[m]], out[own, :k]) @ of[m])
    return out


def passes_of(
    rows: DataFrame, marks: list[str], width: int, places: list[np.ndarray], fitted: list[list[np.ndarray]], weights: dict[int, np.ndarray],
) -> dict[int, np.ndarray]:
    """One pass over the training rows for all models at once. Per model, over the rows outside its fold: their number, those
    with the mark, the loss, its gradient and its Hessian, end to end. A task gives out one row a model."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x, fold = dense(batch, width), batch.column("fold").to_numpy(zero_copy_only=False)
            earlier = out_of_fold(x, fold, places, fitted)
            for m, w in weights.items():
                own = fold != m
                a, y = seen_by(x[own][:, places[m]], earlier[own]), batch.column(marks[m]).to_numpy(zero_copy_only=False)[own]
                z = a @ w
                p = chance(z)
                part = np.concatenate([
                    [len(y), y.sum(), np.logaddexp(0, z).sum() - y @ z], a.T @ (p - y), (a.T @ (a * (p * (1 - p))[:, None])).ravel()])
                total[m] = total[m] + part if m in total else part
        for m, part in total.items():
            yield pa.record_batch({"model": column(np.array([m])), "sums": pa.array([part.tobytes()], pa.binary())})

    names = list(dict.fromkeys(marks[m] for m in weights))
    out: dict[int, np.ndarray] = {}
    # At most TASKS times FOLDS + 1 rows, whose length depends on FEATURES alone.
    for r in rows.select("fold", "at", "x", *names).coalesce(TASKS).mapInArrow(work, "model long, sums binary").collect():
        part = np.frombuffer(r["sums"])
        out[r["model"]] = out[r["model"]] + part if r["model"] in out else part
    return out


def fit(
    rows: DataFrame, marks: list[str], width: int, places: list[np.ndarray], fitted: list[list[np.ndarray]], models: list[int],
) -> dict[int, np.ndarray]:
    """Weights of the models of one category, by Newton steps on the logistic loss with a penalty on standardised weights. A step
    that raises the loss is halved. Rows with one kind only give that kind's probability, whatever the features."""
    size = {m: 1 + len(places[m]) + len(fitted) for m in models}
    weights = {m: np.zeros(size[m]) for m in models}
    safe, best, scale = dict(weights), dict.fromkeys(models, np.inf), {}
    left = list(models)
    for _ in range(PASSES):
        found = passes_of(rows, marks, width, places, fitted, {m: weights[m] for m in left})
        for m in list(left):
            n, ones, loss = found[m][:3] if m in found else (0, 0, 0)
            if not 0 < ones < n:
                safe[m] = np.concatenate([[30.0 if ones else -30.0], np.zeros(size[m] - 1)])
                left.remove(m)
                continue
            slope, bend = found[m][3 : 3 + size[m]] / n, found[m][3 + size[m] :].reshape(size[m], size[m]) / n
            if m not in scale:  # without weights every probability is a half, so the Hessian is a quarter of the second moments
                scale[m] = PENALTY * np.maximum(4 * np.diag(bend) - (4 * bend[0]) ** 2, 1e-8)
                scale[m][0] = 0
            value = loss / n + (scale[m] * weights[m] ** 2).sum() / 2
            if value > best[m] + 1e-12:
                weights[m] = (weights[m] + safe[m]) / 2
                continue
            best[m], safe[m] = value, weights[m]
            slope = slope + scale[m] * weights[m]
            step = np.linalg.solve(bend + np.diag(scale[m] + 1e-9), slope)
            if slope @ step < 1e-9:
                left.remove(m)
            weights[m] = weights[m] - step
        if not left:
            break
    return safe


class Chain:
    """Weights of every category: of the features, then of the earlier categories' probabilities; and the intercepts. `folds`
    holds the features and weights of the models that have not seen a fold, for all categories but the last."""

    def __init__(self, categories: list[str], chosen: np.ndarray):
        self.categories, self.chosen = categories, chosen
        self.weights: list[np.ndarray] = []
        self.intercepts: list[float] = []
        self.folds: list[tuple[np.ndarray, list[np.ndarray]]] = []

    def predict(self, block: Block) -> np.ndarray:
        """One row of probabilities per category."""
        owner, feature, times = counts_of(block, self.chosen)
        out = np.zeros((len(self.categories), block.n))
        for k, (w, b) in enumerate(zip(self.weights, self.intercepts)):
            z = b + np.bincount(owner, w[feature] * np.log1p(times), block.n) + w[len(self.chosen) :] @ out[:k]
            out[k] = chance(z)
        return out


def fit_chain(rows: DataFrame, marks: list[list[str]], categories: list[str], chosen: np.ndarray, places: list[np.ndarray]) -> Chain:
    """`rows`: fold, `at`, `x`, and 0 or 1 in the columns that `marks` names by category and model. Model m has not seen fold m;
    the last one has seen all rows. `places` says which of the chosen features each model reads."""
    chain, fitted = Chain(categories, chosen[places[FOLDS]]), []
    for k in range(len(categories)):
        last = k + 1 == len(categories)  # nothing follows that needs out-of-fold predictions
        found = fit(rows, marks[k], len(chosen), places, fitted, [FOLDS] if last else list(range(FOLDS + 1)))
        chain.intercepts.append(float(found[FOLDS][0]))
        chain.weights.append(found[FOLDS][1:])
        if not last:
            fitted.append([found[m] for m in range(FOLDS)])
    chain.folds = [(chosen[places[m]], [of[m] for of in fitted]) for m in range(FOLDS)]
    return chain


def graded(rows: DataFrame, places: list[np.ndarray], mark: str) -> tuple[DataFrame, list[str]]:
    """A second category where the table has one mark: a document with the mark whose log counts add up to the median of such
    documents or more, over the features that no unmarked document has. Each model's is derived from the rows it may see: a
    column a model, and their names."""
    unmarked = F.lit(1) - F.col(mark)
    own = rows.select(mark, "fold", F.explode("at").alias("at")).groupBy("at").agg(*(
        F.max(F.when(F.col("fold") != m, unmarked)).alias(f"m{m}") for m in range(FOLDS + 1)))
    found = own.collect()  # at most FEATURES a model
    total = []
    for m in range(FOLDS + 1):
        cues = sorted({r["at"] for r in found if r[f"m{m}"] == 0} & set(places[m].tolist()))
        cue = F.array(*map(F.lit, cues)) if cues else F.array().cast("array<int>")
        counted = F.zip_with("at", "x", lambda a, v: F.when(F.array_contains(cue, a), v).otherwise(0.0))  # noqa: B023
        total.append(F.aggregate(counted, F.lit(0.0), lambda a, b: a + b))
    rows = rows.select("*", *(t.alias(f"cues_{m}") for m, t in enumerate(total)))
    middle = rows.filter(F.col(mark) == 1).agg(*(
        F.percentile(F.when(F.col("fold") != m, F.col(f"cues_{m}")), F.lit(0.5)).alias(f"m{m}") for m in range(FOLDS + 1))).first()
    names = [f"graded_{m}" for m in range(FOLDS + 1)]
    return rows.select("*", *(
        ((F.col(mark) == 1) & (F.col(f"cues_{m}") >= F.lit(middle[f"m{m}"] or 0.0)) & (F.col(f"cues_{m}") > 0)).cast("long").alias(name)
        for m, name in enumerate(names))), names


def train(docs: DataFrame, labels: DataFrame, categories: list[str] | None = None) -> Chain | None:
    """The chain for the category columns of `labels`, in the order given; None without labelled documents.

    Without `categories` the chain is that of the one column `toxic`: `severe`, derived by `graded`, then `toxic`. What a fold's
    out-of-fold probabilities come from (features, derived category, weights) has not seen that fold's labels.
    """
    given = categories or ["toxic"]
    columns = [f"c{k}" for k in range(len(given))]
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *(F.max(F.col(c).cast("long")).alias(name) for c, name in zip(given, columns))).dropna()
    share = min(1.0, TRAINING_ROWS / max(1, marks.count()))
    marks = marks.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < share * (1 << 20))
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(marks), "doc_id")  # bounded by TRAINING_ROWS
    prepare(docs.sparkSession)
    texts = materialize(texts.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(FOLDS))), "labelled")
    sums = ["n", *columns]
    total = texts.withColumn("n", F.lit(1)).agg(*(F.sum(c).alias(c) for c in sums), *(
        F.sum(F.when(F.col("fold") == m, F.col(c)).otherwise(0)).alias(f"{c}_{m}") for c in sums for m in range(FOLDS))).first()
    if not total["n"]:
        return None
    found = materialize(occurrences(texts, columns).filter("n >= 3"), "features")
    picked = [np.unique(np.array(choose(found, total, columns, m), np.int64).view(np.uint64)) for m in (*range(FOLDS), None)]
    chosen = np.unique(np.concatenate(picked))
    places = [np.searchsorted(chosen, keys) for keys in picked]
    rows = vectors(texts, chosen, ["fold", *columns])
    rows = stored = materialize(rows, "vectors")
    named = [[c] * (FOLDS + 1) for c in columns]
    if categories is None:
        rows, derived = graded(rows, places, columns[0])
        named, categories = [derived, *named], ["severe", "toxic"]
    chain = fit_chain(rows, named, categories, chosen, places)
    discard(texts, found, stored)
    return chain


def classify(docs: DataFrame, labels: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """doc_id, text_key, one probability p_<category> per category, toxic (any probability of THRESHOLD or more), kept (not
    toxic): one row per row of `docs`.

    Several labels of a document count as their maximum; rows with a null label or id are not learned from. A null or empty
    text has no features. Without labelled documents nothing is toxic. Other columns are not read.
    """
    chain = train(docs, labels, categories)
    names = chain.categories if chain else categories or ["severe", "toxic"]
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # FEATURES weights a category

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                p = shared.value.predict(block) if shared.value else np.zeros((len(names), block.n))
                toxic = (p >= THRESHOLD).any(0)
                yield pa.record_batch(
                    {c: batch.column(c).slice(block.first, block.n) for c in ("doc_id", "text_key")}
                    | {f"p_{c}": column(p[k]) for k, c in enumerate(names)} | {"toxic": column(toxic), "kept": column(~toxic)})

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        work, "doc_id long, text_key long, " + ", ".join(f"p_{c} double" for c in names) + ", toxic boolean, kept boolean")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not toxic, with all their columns. Each is judged where it is read; nothing is shuffled.

    A null or empty text has no features; rows with a null id are judged like others; repeated rows each stay or go. Without
    labelled documents, and from an empty table, every row stays. The columns must be of types that Arrow can carry.
    """
    chain = train(docs, labels)
    if chain is None:
        return docs
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # FEATURES weights a category

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(shared.value.predict(block) < THRESHOLD).all(0) for block in blocks(batch)]
            yield batch.filter(pa.array(np.concatenate(kept))) if kept else batch

    return docs.mapInArrow(work, docs.schema)
