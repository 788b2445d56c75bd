"""Repeated passages by suffix trees over groups of suffixes with a common prefix.

A suffix is a word position with at least `width` words to the end of its text; only its first `width` words matter. Its prefix
is of variable length: it ends with the suffix's anchor, the PREFIX-word piece with the smallest hash among those in its first
`width` words, so equal suffixes have equal prefixes. Neighbouring suffixes mostly have the same anchor and travel as one
stretch. Prefixes that only one document has are dropped with all their suffixes. Stretches with the same words are one. The
stretches of a prefix come together in one group, whose suffixes are sorted by prefix doubling; the suffixes of one rank at
depth `width` are the leaves under one deep internal node of the group's suffix tree, whose smallest document is the one that
keeps the passage. A prefix with more than GROUP different stretches is extended to the full depth: its nodes are then found by
an aggregate, which combines before its shuffle, so no group is larger than memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.joins import join_counted, total
from shelfline.llm.text import _STEPS, Block, blocks, column, mix, prepare, range_hash, reduce_by_text, word_hash
from shelfline.session import discard, materialize

WIDTH, PREFIX, GROUP = 50, 12, 4096
CHUNK_WORDS = 1 << 20
_ONE, _TWO = np.uint64(0x1B873593A0761D65), np.uint64(0xCC9E2D51E7037ED1)


def words_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, unchanged, and where each text's begin."""
    starts, ends, first = block.words()
    return word_hash(block.data, starts, ends), first


def pieces(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the `width` words from each word on. Those that run into the next text are never read."""
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    out = np.zeros(len(words), np.uint64)
    for j in range(width):
        out += padded[j : j + len(words)] * _STEPS[j]
    return mix(out)


def stretches(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Runs of suffixes with one anchor: the text of each, its first suffix (as a word of the block), the number of suffixes, the
    hash of the anchor and that of all words from the first suffix to the last one's depth."""
    prefix = min(PREFIX, width)
    reach = width - prefix + 1
    n = np.maximum(np.diff(first) - width + 1, 0)
    begin = np.concatenate([[0], np.cumsum(n)])
    none = np.zeros(0, np.int64)
    if not begin[-1]:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    piece = pieces(words, prefix)
    # least[i]: place of the first smallest of piece[i : i + size].
    least, size = np.arange(len(words)), 1
    while size < reach:
        step = min(size, reach - size)
        left, right = least[:-step], least[step:]
        least = np.concatenate([np.where(piece[right] < piece[left], right, left), least[-step:]])
        size += step
    text = np.repeat(np.arange(len(n)), n)
    start = np.arange(begin[-1]) + (first[:-1] - begin[:-1])[text]
    anchor = least[start]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    run = np.flatnonzero(fresh)
    times = np.diff(np.append(run, len(start)))
    start = start[run]
    return text[run], start, times, piece[anchor[run]], range_hash(piece, start, start + times - 1 + reach)


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key, n_words, two hashes of the whole word sequence, and the stretches (prefix, words, at, n)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                words, first = words_of(block)
                n = np.diff(first)
                place = (np.arange(len(words)) - np.repeat(first[:-1], n)).astype(np.uint64)
                one = reduce_by_text(np.add, mix(words ^ mix(place + _ONE)), first, 0) + n.astype(np.uint64)
                two = reduce_by_text(np.add, mix(words + mix(place ^ _TWO)), first, 0)
                text, start, times, prefix, whole = stretches(words, first, width)
                entry = pa.StructArray.from_arrays(
                    [column(prefix), column(whole), column(start - first[text]), column(times.astype(np.int32))],
                    names=["prefix", "words", "at", "n"])
                bounds = np.searchsorted(text, np.arange(block.n + 1)).astype(np.int32)
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(block.first, block.n),
                    "text_key": batch.column("text_key").slice(block.first, block.n),
                    "n_words": column(n.astype(np.int64)), "one": column(mix(one)), "two": column(mix(two)),
                    "stretches": pa.ListArray.from_arrays(pa.array(bounds), entry)})

    return keyed(docs).mapInArrow(
        work, "doc_id long, text_key long, n_words long, one long, two long, "
              "stretches array<struct<prefix:long, words:long, at:long, n:int>>")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")


def nodes_at(words: np.ndarray, width: int) -> np.ndarray:
    """The rank of every suffix at depth `width` by prefix doubling: equal ranks are leaves under one node of that depth."""
    rank, size = np.unique(words, return_inverse=True)[1], 1
    while size < width:
        step = min(size, width - size)
        both = rank[:-step] * np.int64(len(words) + 1) + rank[step:]
        rank, size = np.unique(both, return_inverse=True)[1], size + step
    return rank


def runs(lo: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values within a text."""
    fresh = np.ones(len(lo), bool)
    fresh[1:] = (lo[1:] != lo[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(fresh)
    return at, np.diff(np.append(at, len(lo)))


RUN = "prefix long, words long, times long, begin int, end int, lo long"


def subtrees(table: pa.Table, width: int) -> pa.RecordBatch:
    """Whole groups of stretches: the smallest document under each suffix's deep node, as runs of suffixes within a stretch."""
    lists = table.column("sequence").combine_chunks()
    words, first = lists.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    lo, hi = table.column("lo").to_numpy(), table.column("hi").to_numpy()
    n = np.diff(first) - width + 1
    text = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(text)) - np.repeat(np.concatenate([[0], np.cumsum(n)])[:-1], n)
    node = nodes_at(words, width)[first[:-1][text] + inside]
    least = np.full(int(node.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, node, lo[text])
    found = least[node]
    at, length = runs(found, text)
    keep = found[at] < hi[text[at]]
    at, length = at[keep], length[keep]
    whose = text[at]
    return pa.record_batch(
        {c: table.column(c).combine_chunks().take(pa.array(whose)) for c in ("prefix", "words", "times")}
        | {"begin": pa.array(inside[at].astype(np.int32)), "end": pa.array((inside[at] + length).astype(np.int32)), "lo": pa.array(found[at])})


def grouped(sequences: DataFrame, width: int) -> DataFrame:
    """The runs of all prefixes' groups. Each prefix is in one partition, ordered; a task takes as many groups at a time as
    CHUNK_WORDS words hold, and at least one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, words = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            words += len(batch.column("sequence").flatten())
            if words < CHUNK_WORDS:
                continue
            table = pa.Table.from_batches(waiting)
            prefix = table.column("prefix").to_numpy()
            cut = int(np.flatnonzero(prefix == prefix[-1])[0])  # the last group may go on
            if cut:
                yield subtrees(table.slice(0, cut), width)
                waiting = table.slice(cut).combine_chunks().to_batches()
                words = sum(len(b.column("sequence").flatten()) for b in waiting)
        if waiting:
            yield subtrees(pa.Table.from_batches(waiting), width)

    return sequences.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(work, RUN)


def extended(sequences: DataFrame, width: int) -> DataFrame:
    """The runs of prefixes with too many stretches for a group: their suffixes, known by all `width` words, are aggregated."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("sequence")
            words, first = lists.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            n = np.diff(first) - width + 1
            text = np.repeat(np.arange(len(n)), n)
            inside = np.arange(len(text)) - np.repeat(np.concatenate([[0], np.cumsum(n)])[:-1], n)
            at = first[:-1][text] + inside
            node = pa.StructArray.from_arrays(
                [column(pieces(words, width)[at]), column(pieces(mix(words ^ _ONE), width)[at])], names=["one", "two"])
            yield pa.record_batch(
                {c: batch.column(c).take(pa.array(text)) for c in ("prefix", "words", "times", "lo", "hi")}
                | {"begin": pa.array(inside.astype(np.int32)), "node": node})

    leaves = materialize(sequences.mapInArrow(
        work, "prefix long, words long, times long, lo long, hi long, begin int, node struct<one:long, two:long>"), "leaves")
    nodes = leaves.groupBy("node").agg(F.min("lo").alias("least"), F.count("*").alias("leaves")).filter("leaves > 1")
    nodes = materialize(nodes, "nodes")
    found = join_counted(leaves, nodes, "node", "leaves", total(nodes, "leaves")).filter("least < hi")
    out = materialize(found.select(
        "prefix", "words", "times", "begin", (F.col("begin") + 1).alias("end"), F.col("least").alias("lo")), "extended")
    discard(leaves, nodes)
    return out


def marked(docs: DataFrame, sketched: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key and spans (begin, end) of words that are covered by a passage of a smaller document."""
    whole = sketched.filter(F.col("n_words") >= width)
    # Texts with the same words count once, as the smallest document that has them; all others go as a whole.
    classes = materialize(
        whole.groupBy(F.struct("one", "two").alias("sequence")).agg(
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))).alias("least"), F.count("*").alias("times"),
            F.first("stretches").alias("stretches")).filter("least IS NOT NULL"), "classes")
    copies = join_counted(
        whole.select(F.struct("one", "two").alias("sequence"), "doc_id", "text_key", "n_words"),
        classes.select("sequence", "least", "times"), "sequence", "times", total(classes, "times"))
    copies = copies.filter("least.doc_id < doc_id").select(
        "doc_id", "text_key", F.lit(0).cast("long").alias("begin"), F.col("n_words").alias("end")).distinct()

    each = classes.select("least.*", F.explode("stretches").alias("s")).select("doc_id", "text_key", "s.*")
    prefixes = materialize(
        each.groupBy("prefix").agg(F.count("*").alias("_n"), F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi"))
        .filter("_lo < _hi").select("prefix", "_n"), "prefixes")
    held = materialize(join_counted(each, prefixes, "prefix", "_n", total(prefixes, "_n")).drop("_n"), "held")
    copies = materialize(copies, "copies")
    discard(classes, prefixes)

    # Stretches with the same words are one; where a prefix has no other, its smallest document is known.
    same = held.groupBy("prefix", "words").agg(
        F.min(F.struct("doc_id", "text_key", "at")).alias("least"), F.max("doc_id").alias("hi"), F.first("n").alias("n"),
        F.count("*").alias("times"))
    per_prefix = materialize(same.groupBy("prefix").agg(F.count("*").alias("_stretches")), "per_prefix")
    same = materialize(join_counted(same, per_prefix, "prefix", "_stretches", total(per_prefix, "_stretches")), "same")
    alone = same.filter("_stretches = 1 AND least.doc_id < hi").select(
        "prefix", "words", "times", F.lit(0).alias("begin"), F.col("n").alias("end"), F.col("least.doc_id").alias("lo"))
    sequences = materialize(sequences_of(docs, same.filter("_stretches > 1"), width), "sequences")
    small, large = sequences.filter(~F.col("large")), sequences.filter("large")
    deep = grouped(small, width)
    if not large.isEmpty():
        deep = deep.unionByName(extended(large, width))
    answers = materialize(
        alone.unionByName(deep).groupBy("prefix", "words").agg(
            F.first("times").alias("times"), F.collect_list(F.struct("begin", "end", "lo")).alias("runs"))
        .withColumn("stretch", F.struct("prefix", "words")).drop("prefix", "words"), "answers")
    discard(per_prefix, same, sequences)
    known = join_counted(
        held.withColumn("stretch", F.struct("prefix", "words")).select("stretch", "doc_id", "text_key", "at"), answers, "stretch", "times",
        total(answers, "times"))
    passages = known.select("doc_id", "text_key", "at", F.explode("runs").alias("r")).filter("r.lo < doc_id").select(
        "doc_id", "text_key", (F.col("at") + F.col("r.begin")).alias("begin"), (F.col("at") + F.col("r.end") - 1 + width).alias("end"))
    spans = materialize(
        passages.unionByName(copies).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("begin", "end")).alias("spans")), "spans")
    discard(held, answers, copies)
    return spans


def sequences_of(docs: DataFrame, same: DataFrame, width: int) -> DataFrame:
    """The words of one occurrence of each stretch: prefix, words, times, lo, hi, large, sequence."""
    marks = same.select(
        F.col("least.doc_id").alias("_id"), F.col("least.text_key").alias("_key"),
        F.struct(F.col("least.at").alias("at"), "n", "prefix", "words", "times", "hi", (F.col("_stretches") > GROUP).alias("large")).alias("m"))
    marks = marks.groupBy("_id", "_key").agg(F.collect_list("m").alias("marks"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = batch.column("marks")
            bounds, marks = each.offsets.to_numpy(), each.values
            of = {c: marks.field(c) for c in ("at", "n", "prefix", "words", "times", "hi", "large")}
            for block in blocks(batch):
                words, first = words_of(block)
                low, high = bounds[block.first], bounds[block.first + block.n]
                text = np.repeat(np.arange(block.n), np.diff(bounds[block.first : block.first + block.n + 1]))
                begin = first[text] + of["at"].to_numpy()[low:high]
                length = of["n"].to_numpy()[low:high] - 1 + width
                offsets = np.concatenate([[0], np.cumsum(length)])
                place = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], length)
                for part in range(0, len(text), 1 << 13):
                    some = slice(part, part + (1 << 13))
                    at = offsets[part : part + (1 << 13) + 1]
                    yield pa.record_batch(
                        {c: of[c].slice(low, high - low)[some] for c in ("prefix", "words", "times", "hi", "large")}
                        | {"lo": batch.column("doc_id").take(pa.array(text[some] + block.first)),
                           "sequence": pa.ListArray.from_arrays(pa.array((at - at[0]).astype(np.int32)), column(words[place[at[0] : at[-1]]]))})

    found = keyed(docs).join(marks, (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_key")))
    # A row that the input repeats comes once. The rows lie by these keys already, which their sequences would not.
    once = found.select("doc_id", "text_key", "text", "marks").dropDuplicates(["doc_id", "text_key"]).select("doc_id", "text", "marks")
    return once.mapInArrow(work, "prefix long, words long, times long, hi long, large boolean, lo long, sequence array<long>")


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, n_removed, spans (merged, as word numbers from 0) and kept_text of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = batch.column("spans")
            lengths = each.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            flat = each.flatten()
            begin, end = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("begin", "end"))
            for block in blocks(batch):
                starts, ends, first = block.words()
                low, high = bounds[block.first], bounds[block.first + block.n]
                text = np.repeat(np.arange(block.n), np.diff(bounds[block.first : block.first + block.n + 1]))
                change = np.zeros(len(starts) + 1, np.int64)
                np.add.at(change, first[text] + begin[low:high], 1)
                np.add.at(change, first[text] + end[low:high], -1)
                gone = np.cumsum(change[:-1]) > 0
                owner = np.repeat(np.arange(block.n), np.diff(first))
                at, length = runs(gone.astype(np.int64), owner)
                at, length = at[gone[at]], length[gone[at]]
                pairs = pa.StructArray.from_arrays(
                    [column(at - first[owner[at]]), column(at + length - first[owner[at]])], names=["begin", "end"])
                merged = np.searchsorted(owner[at], np.arange(block.n + 1)).astype(np.int32)
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(block.first, block.n),
                    "text_key": batch.column("text_key").slice(block.first, block.n),
                    "n_words": column(np.diff(first).astype(np.int64)),
                    "n_removed": column(np.bincount(owner, gone, block.n).astype(np.int64)),
                    "spans": pa.ListArray.from_arrays(pa.array(merged), pairs),
                    "kept_text": joined(block, starts, ends, owner, ~gone)})

    both = keyed(docs).join(
        spans.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "spans"),
        (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    return both.select("doc_id", "text_key", "text", "spans").mapInArrow(
        work, "doc_id long, text_key long, n_words long, n_removed long, spans array<struct<begin:long, end:long>>, kept_text string")


def joined(block: Block, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, kept: np.ndarray) -> pa.Array:
    """Each text's kept words with one space between them."""
    starts, ends, owner = starts[kept], ends[kept], owner[kept]
    change = np.zeros(len(block.data) + 1, np.int32)
    change[starts] += 1
    change[ends] -= 1
    mask = np.cumsum(change[:-1]) > 0
    gap = ends[:-1][owner[1:] == owner[:-1]]  # at least one space follows all but a text's last word
    data = block.data.copy()
    data[gap] = 32
    mask[gap] = True
    size = np.concatenate([[0], np.cumsum(mask)])[block.offsets]
    return pa.LargeStringArray.from_buffers(block.n, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(data[mask])).cast(pa.string())


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_key, n_words, n_removed, spans, kept_text: one row per row of `docs`.

    A word goes if it is covered by `width` consecutive words that also start in a document with a smaller doc_id. Words are
    `[^\\x20\\x09-\\x0D]+`, unchanged. A text with fewer words, an empty or a null one keeps its words; a null doc_id is not
    smaller than any and loses nothing. Rows with the same id don't take words from each other, so repeated rows have the same
    result. `spans` are the removed words' numbers, merged; `kept_text` joins the others by one space. An empty table gives no
    rows. Other columns are not read.
    """
    prepare(docs.sparkSession)
    sketched = materialize(sketch(docs, width), "sketch")
    spans = marked(docs, sketched, width)
    discard(sketched)
    return cut(docs, spans)
