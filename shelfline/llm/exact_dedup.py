"""Exact duplicates by a tree merge of sorted runs of digests.

The digest table is dealt into a power of two of runs, each sorted by digest. The runs are merged in binomial rounds: in a round,
partitions whose numbers differ in one group of three bits exchange, each keeping the digests that have its own bits there, and
merge the eight sorted pieces they get, so that a digest is left with its smallest identifier and its counts. After the last round
partition p holds the digests whose leading bits are p: sorted, disjoint ranges, and no root task. A digest that many rows share
reaches a partition at most eight times a round, once from each partner. Rounds: the logarithm to base 8 of the number of runs;
each moves one row per digest and run. Lost executors cost the shuffle files of their own runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.joins import join_counted, packed, total, unpacked
from shelfline.session import materialize

FAN_IN_BITS = 3


def normalised(text: str | Column = "text") -> Column:
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    """48 bytes: SHA-256, an independent 64-bit hash and the length. The last two verify that equal digests are equal texts:
    rows of which they differ are never merged."""
    number = lambda c: F.lpad(F.hex(c), 16, "0")
    return F.unhex(F.concat(F.sha2(text.cast("binary"), 256), number(F.xxhash64(text)), number(F.octet_length(text).cast("long"))))


def smallest(null: str | Column, number: str | Column) -> Column:
    """The smallest identifier, null only if all are, as a pair (is null, identifier). An aggregate of pairs goes by sorting: it
    reads its input in order of the keys and leaves its output so."""
    return F.min(F.struct(null, number)).alias("least")


def leading_bits(bits: int) -> Column:
    """The digest's first bits as a number; there are at most 31."""
    return F.expr(f"cast(shiftright(cast(conv(hex(substring(digest, 1, 4)), 16, 10) as bigint), {32 - bits}) as int)")


def sorted_runs(rows: DataFrame, bits: int) -> DataFrame:
    """run, digest, least, group_size, n_ids: what each of 2^bits groups of partitions holds, one row per digest and run. The
    first half of this aggregate runs before the exchange: a partition with many copies sends one row for them."""
    return rows.groupBy(F.expr(f"pmod(spark_partition_id(), {1 << bits})").alias("run"), "digest").agg(
        smallest(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id")), F.sum("copies").alias("group_size"),
        F.count("*").alias("n_ids"))


def merged(run: DataFrame, bits: int) -> DataFrame:
    """All rounds over 2^bits runs. The partner a row goes to has the digest's bits in the round's group, and its run's own
    bits elsewhere."""
    owner = leading_bits(bits)
    for low in reversed(range(bits % -FAN_IN_BITS, bits, FAN_IN_BITS)):  # leading bits first
        mask = ((1 << FAN_IN_BITS) - 1) << low if low >= 0 else (1 << (low + FAN_IN_BITS)) - 1
        partner = F.col("run").bitwiseAND(F.lit(~mask)).bitwiseOR(owner.bitwiseAND(F.lit(mask)))
        # The rows are where their aggregate needs them, so it merges in place.
        run = run.withColumn("run", partner).repartitionById(1 << bits, "run").groupBy("run", "digest").agg(
            smallest("least.unknown", "least.id"), F.sum("group_size").alias("group_size"), F.sum("n_ids").alias("n_ids"))
    return run


def merge_runs(rows: DataFrame) -> DataFrame:
    """run, digest, keep_id (smallest doc_id, null only if all are), group_size (rows), n_ids (rows of `rows`) over all runs. A
    file holds one run in order of its digests, and the runs are disjoint. There are as many as shuffle partitions, rounded up to
    a power of two."""
    bits = (int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    run = merged(sorted_runs(rows, bits), bits)
    return materialize(run.select("run", "digest", F.col("least.id").alias("keep_id"), "group_size", "n_ids"), "runs")


def marked(docs: DataFrame) -> DataFrame:
    """One row per (doc_id, digest): copies, keep_id, group_size, and whether it stays."""
    rows = materialize(
        docs.select("doc_id", normalised().alias("_text")).select("doc_id", digest(F.col("_text")).alias("digest"))
        .groupBy("doc_id", "digest").agg(F.count("*").alias("copies")),
        "digests")
    groups = merge_runs(rows).drop("run")
    return join_counted(rows, groups, "digest", "n_ids", total(groups, "n_ids")).withColumn(
        "stays", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def dedup(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with equal normalised texts the smallest doc_id stays; null ids come last. Of repeated rows (same id, same text)
    one stays. Null and empty texts are equal to each other. An empty table gives no rows. Other columns are not read.
    """
    return marked(docs).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc_id", "keep_id", "group_size", ((F.col("_copy") == 1) & F.col("stays")).alias("kept"),
        F.lower(F.hex(F.substring("digest", 1, 32))).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Of repeated rows any one stays."""
    stay = materialize(
        marked(docs).filter("stays").select(
            F.col("doc_id").alias("__id"), F.col("digest").alias("__kept_digest"), F.col("copies").alias("__copies")),
        "stay")
    keyed = packed(docs).withColumn("__digest", digest(normalised("__row.text")))
    found = keyed.join(stay, F.col("__row.doc_id").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__kept_digest")))
    if stay.filter("__copies > 1").isEmpty():
        return unpacked(found)
    repeated = found.filter("__copies > 1").dropDuplicates(["__id", "__digest"])
    return unpacked(found.filter("__copies = 1").unionByName(repeated))
