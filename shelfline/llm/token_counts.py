"""Token counts of documents in flat token files: 16-bit ids, one document after the other, each followed by a separator.

The files have no index. Each is cut into blocks; a block is searched for separators as one array, whatever documents it
cuts through. A prefix scan over the blocks of a file (tokens so far, separators so far, place of the last separator so far)
then stitches the documents that run across blocks. Only block summaries are shuffled, never tokens.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.bpe import Vocabulary
from shelfline.llm.text import blocks, column, prepare
from shelfline.session import materialize, shared_folder

SEPARATOR = 50256
BLOCK_BYTES = 1 << 18


def _pin_splits(spark: SparkSession) -> None:
    """Makes the split of a scan into partitions depend on its files alone, not on the executors that are there."""
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        spark.conf.set("spark.sql.files.minPartitionNum", spark.conf.get("spark.sql.shuffle.partitions"))


def write_flat(docs: DataFrame, path: str, vocabulary: str) -> None:
    """Encodes all whole texts and writes one flat file per partition, documents in the order of the table.

    Spark's text writer gives out bytes as they are, with the separator's two bytes where a line would end. A null or empty
    text is a separator alone.
    """
    spark = docs.sparkSession
    prepare(spark)
    _pin_splits(spark)
    shared = spark.sparkContext.broadcast(Vocabulary.load(vocabulary))  # bounded by the vocabulary file

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                ids, first = shared.value.encode(block)
                yield pa.record_batch({"ids": pa.Array.from_buffers(pa.large_binary(), block.n, [
                    None, pa.py_buffer((first * 2).astype(np.int64)), pa.py_buffer(ids.astype("<u2"))]).cast(pa.binary())})

    end = SEPARATOR.to_bytes(2, "little").decode("latin-1")
    (docs.select("doc_id", "text").mapInArrow(work, "ids binary").select(F.col("ids").cast("string").alias("value"))
     .write.mode("overwrite").option("lineSep", end).option("encoding", "ISO-8859-1").text(path))


def read_blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """file (its path), block (its number in the file), payload: the files of a folder, cut without regard to documents."""
    whole = spark.read.format("binaryFile").load(path).filter("length > 0")
    # Each block is taken from the file's bytes as it is handed on; there is never a second copy of the file.
    numbered = whole.select("path", "content", F.explode(F.expr(f"sequence(0, cast((length - 1) div {block_bytes} as int))")).alias("block"))
    return numbered.select(F.col("path").alias("file"), "block", F.expr(f"substring(content, block * {block_bytes} + 1, {block_bytes})").alias("payload"))


def scan(pieces: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """One row per block: file, block, tokens, separators, head (tokens before the first), last (place of the last, or -1), and
    inner, the counts between separators."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payload = batch.column("payload").cast(pa.large_binary())
            bounds = np.frombuffer(payload.buffers()[1], np.int64)[payload.offset : payload.offset + len(payload) + 1]
            ids = np.frombuffer(payload.buffers()[2], "<u2", (bounds[-1] - bounds[0]) // 2, bounds[0])
            begin = (bounds - bounds[0]) // 2
            at = np.flatnonzero(ids == separator)
            first = np.searchsorted(at, begin)
            n = np.diff(first)
            some = n > 0
            place = lambda i: np.where(some, at[np.clip(i, 0, max(0, len(at) - 1))] if len(at) else -1, -1)  # noqa: B023, E731
            head, last = place(first[:-1]) - begin[:-1], place(first[1:] - 1) - begin[:-1]
            inner, starts = np.diff(at) - 1, np.zeros(len(at), bool)
            starts[first[:-1][some]] = True  # a block's first separator ends a document that may have begun before
            yield pa.record_batch({
                "file": batch.column("file"), "block": batch.column("block"), "tokens": column(np.diff(begin)),
                "separators": column(n.astype(np.int64)), "head": column(np.where(some, head, 0)), "last": column(np.where(some, last, -1)),
                "inner": pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.maximum(n - 1, 0))]), pa.int32()),
                    column((inner[~starts[1:]] if len(at) else inner).astype(np.int64)))})

    prepare(pieces.sparkSession)
    return pieces.mapInArrow(
        work, "file string, block int, tokens long, separators long, head long, last long, inner array<long>")


def count_tokens(pieces: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """file, ordinal (of the document in its file, from 0), n_tokens (the separator not counted), ended.

    What stands after a file's last separator is a document that has not ended; a file that ends in a separator has none. Two
    separators in a row hold an empty document. Empty files and an empty table give no rows.
    """
    found = materialize(scan(pieces, separator), "blocks")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    at = found.withColumns({
        "start": F.coalesce(F.sum("tokens").over(earlier), F.lit(0)), "nth": F.coalesce(F.sum("separators").over(earlier), F.lit(0))})
    placed = at.withColumn("final", F.when(F.col("separators") > 0, F.col("start") + F.col("last"))).withColumn(
        "open", F.coalesce(F.max("final").over(earlier), F.lit(-1)))
    carried = F.col("start") - F.col("open") - 1
    ended = placed.filter("separators > 0").select(
        "file", "nth", F.posexplode(F.concat(F.array(carried + F.col("head")), "inner")).alias("i", "n_tokens")).select(
        "file", (F.col("nth") + F.col("i")).alias("ordinal"), "n_tokens", F.lit(True).alias("ended"))
    whole = placed.groupBy("file").agg(
        F.sum("tokens").alias("tokens"), F.sum("separators").alias("ordinal"), F.coalesce(F.max("final"), F.lit(-1)).alias("final"))
    rest = F.col("tokens") - F.col("final") - 1
    return ended.unionByName(whole.filter(rest > 0).select("file", "ordinal", rest.alias("n_tokens"), F.lit(False).alias("ended")))


def count_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, part (number of the flat file), ordinal, n_tokens: documents written to flat files, counted from the files.

    One row per row of `docs`, which is read twice and has to come in the same order, as a table of files does. A file whose
    documents don't agree in number with its part of the table, or that has tokens for an empty text, is an error.
    """
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/flat-{uuid.uuid4().hex}"
    write_flat(docs, path, vocabulary)
    counted = count_tokens(read_blocks(spark, path)).withColumn("part", F.regexp_extract("file", r"part-(\d+)", 1).cast("int"))
    row = F.monotonically_increasing_id()  # the partition's number and the row's in it
    names = docs.select("doc_id", "text").select(
        F.col("doc_id").cast("long"), F.shiftright(row, 33).cast("int").alias("part"), row.bitwiseAND((1 << 33) - 1).alias("ordinal"),
        F.coalesce(F.octet_length("text"), F.lit(0)).alias("_bytes"))
    both = counted.join(names, ["part", "ordinal"], "full")
    lost = F.raise_error(F.concat(F.lit("flat file and table differ in part "), F.col("part")))
    return both.filter(F.when(F.col("ended") & ((F.col("n_tokens") > 0) == (F.col("_bytes") > 0)), True).otherwise(lost)).select("doc_id", "part", "ordinal", "n_tokens")
