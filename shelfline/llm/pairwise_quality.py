"""A Bradley-Terry quality score: what it takes for one document to be preferred to another.

Every labelled good document is paired with bad ones. The probability that the better one of a pair is preferred is the
logistic function of the difference of their scores, and a score is linear in the document's measures, so the fit is a
logistic regression on differences of measures without an intercept. The threshold is a quantile of the training scores; a
document's result is the probability of being preferred to a document that lies at the threshold, moved so that the
threshold itself gets `CUT`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import log

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.joins import crc_of
from shelfline.llm.measures import between, flags, per_text, repeated_lines, repeated_words
from shelfline.llm.text import blocks, column, distinct, prepare, span_hash
from shelfline.operators.ordered import exact_quantiles
from shelfline.session import materialize

CUT = 0.7
ROUNDS, GROUP = 4, 32

MEASURES = (
    "long", "word_bytes", "symbols", "exclaiming", "separators", "capitals", "digits", "marks", "twins", "repeated_windows",
    "distinct_words", "repeated_lines", "line_words", "unended_lines", "short", "others")


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every whole text, each in a fixed range; nothing but the text enters them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                begin, end, first = block.words()
                starts, ends, lines = block.lines()
                keys = span_hash(block.prefix(lower=True), begin, end)
                n = np.diff(first)
                some, size = np.maximum(n, 1), np.maximum(np.diff(block.offsets), 1)
                placed = np.searchsorted(begin, np.stack([starts, ends]))
                full = placed[1] > placed[0]
                n_lines = np.maximum(per_text(full, lines), 1)
                final = block.data[np.maximum(ends - 1, 0)] if len(block.data) else np.zeros(len(ends), np.uint8)
                share = lambda f: per_text(between(f, begin, end), first) / size  # noqa: B023, E731
                twins = np.zeros(len(keys), bool)
                twins[1:] = keys[1:] == keys[:-1]
                twins[first[:-1][n > 0]] = False
                capital = (block.data >= 65) & (block.data <= 90)
                small = (block.data >= 97) & (block.data <= 122)
                letters = np.maximum(block.counts(capital | small), 1)
                columns = (
                    np.log1p(n) / 10, np.minimum(per_text(end - begin, first) / some, 20) / 20, share(flags(block, b"#*$%&|<>")),
                    per_text(block.data[end - 1] == ord("!"), first) / some,
                    per_text((end - begin == 1) & (block.data[begin] == ord("|")), first) / some,
                    block.counts(capital) / letters, share(flags(block, b"0123456789")), np.minimum(share(flags(block, b".,;:?")), 0.2) * 5,
                    per_text(twins, first) / some, repeated_words(keys, first) / some,
                    np.diff(distinct(keys, first)[2]) / some, repeated_lines(block, starts, ends, lines, full) / n_lines,
                    np.minimum(n / n_lines, 100) / 100, per_text(full & ~np.isin(final, list(b".!?\"')")), lines) / n_lines,
                    n < 10, share(flags(block, b"@/\\^~_={}[]")))
                values = np.stack([np.asarray(c, np.float64) for c in columns], 1)
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(block.first, block.n),
                    "measures": pa.ListArray.from_arrays(
                        np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), column(np.ascontiguousarray(values).ravel()))})

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "doc_id long, measures array<double>")


def preference_pairs(rows: DataFrame) -> DataFrame:
    """Differences of measures, better minus worse (label 1) or the other way round (label 0, every second pair).

    Rows are dealt into groups of about GROUP bad documents, anew in each round; a good document meets one bad one of its
    group a round, so pairs grow with the rows and a group never forms all its pairs.
    """
    worse = rows.filter("quality = 0").count()
    groups = max(1, worse // GROUP)
    rounds = []
    for seed in range(ROUNDS):
        dealt = rows.withColumn("_group", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(groups)))
        turn = Window.partitionBy("_group").orderBy(F.xxhash64("doc_id", F.lit(seed + ROUNDS)), "doc_id")
        size = Window.partitionBy("_group")
        bad = dealt.filter("quality = 0").select(
            "_group", F.col("measures").alias("low"), (F.row_number().over(turn) - 1).alias("_turn"), F.count("*").over(size).alias("_n"))
        sizes = bad.groupBy("_group").agg(F.first("_n").alias("_n"))
        good = dealt.filter("quality = 1").select("_group", F.col("measures").alias("high"), (F.row_number().over(turn) - 1).alias("_at"))
        rounds.append(
            good.join(sizes, "_group").withColumn("_turn", F.col("_at") % F.col("_n")).join(bad.drop("_n"), ["_group", "_turn"])
            .select("high", "low", (F.col("_at") % 2).cast("double").alias("label")))
    pairs = reduce(DataFrame.unionAll, rounds)
    up = F.zip_with("high", "low", lambda a, b: a - b)
    down = F.zip_with("low", "high", lambda a, b: a - b)
    return pairs.select("label", array_to_vector(F.when(F.col("label") == 1, up).otherwise(down)).alias("features"))


def linear(weights: list[float]) -> Column:
    return reduce(lambda a, b: a + b, (F.col("measures")[i] * F.lit(w) for i, w in enumerate(weights)))


def score(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if score >= CUT): one row per row of `docs`.

    Only labels of rows with crc32(doc_id as text) mod `folds` other than `held_out` are used, all of them however many there are;
    a null id has no label. Several labels of a document count as their maximum. Null and empty texts have the measures of a text
    without words. Without good or without bad training documents every score is CUT. Other columns are not read.
    """
    measured = materialize(measure(docs).withColumn(
        "held_out", F.coalesce(crc_of(F.col("doc_id")) % folds == held_out, F.lit(False))), "measures")
    marks = labels.filter("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("quality").alias("quality"))
    training = materialize(measured.filter("not held_out").join(marks, "doc_id"), "training")
    both = training.agg(F.coalesce(F.avg(1 - F.col("quality")), F.lit(0.0)).alias("bad")).first()["bad"]
    if not 0 < both < 1:
        return measured.select("doc_id", "held_out", F.lit(CUT).alias("score"), F.lit(1).alias("predicted"))
    pairs = materialize(preference_pairs(training), "pairs")
    fitted = LogisticRegression(fitIntercept=False, regParam=1e-3, maxIter=60).fit(pairs)
    raw = linear(fitted.coefficients.toArray().tolist())
    # Half way between the scores just below and just above the share of bad documents.
    marks = exact_quantiles(training.select(raw.alias("raw")), [], "raw", {"low": max(0.0, both - 0.01), "high": min(1.0, both + 0.01)}).first()
    chance = 1 / (1 + F.exp(-(raw - F.lit(sum(marks) / 2) + F.lit(log(CUT / (1 - CUT))))))
    return measured.select("doc_id", "held_out", chance.alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
