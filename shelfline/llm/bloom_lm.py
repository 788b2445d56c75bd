"""A bigram language model whose counts are read from a log-frequency Bloom filter.

Every bigram of the training texts is in the filter, once for each step of its count on a logarithmic scale from 1 up; a count is
read back by probing steps until one is absent. The filter is cut into shards by ranges of the key's hash. The shard of the
frequent bigrams goes to all workers: fewer than PAIR_SHARE bigrams can each make up one PAIR_SHARE-th of all. Any other shard
lives in the task that owns its range: each block of texts sends its bigrams there once, packed, with its row numbers and whether
the text trains; the task adds up the training counts, sets the shard's bits, probes it for all bigrams that it was sent, and
sends each block the sums of what they add to its texts. So the bits grow with the corpus and no count is ever lost or collected;
what is frequent only decides where a shard lies, never what a bigram scores. Tokens that make up one TOKEN_SHARE-th of all
are known to the workers with their counts; the others' counts come with the bigrams that end in them, which are sent by the token.

With c exact token counts and q(v, w) the least count of the step of a bigram's count: P(w | v) = (q(v, w) + D p(w)) / (c(v) + D)
with p(w) = (c(w) + 1) / (N + V + 1). Every word of a text has a successor, so over all words this adds up to no more than one
(a bigram that isn't in the filter is taken for one with the filter's error rate). log10 P of a text is a sum over tokens of
log10 p(w) and over bigrams of log10(D / (c(v) + D)) + log10(1 + q(v, w) / (D p(w))).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.joins import crc_of
from shelfline.llm.text import Block, blocks, column, lowered, mix, prepare, word_hash
from shelfline.session import discard, materialize

TOKEN_SHARE, PAIR_SHARE = 1 << 20, 1 << 14
RANGE_TOKENS = 1 << 21
"""A range holds this many tokens on average, and of one key less than one PAIR_SHARE-th of all more."""
SMOOTHING = 8.0
STEP = 2 ** 0.25
PROBES, BITS_PER_ENTRY = 7, 12
END = np.uint64(0x5851F42D4C957F2D)
_SECOND = np.uint64(0x9E3779B97F4A7C15)
_KEY_BYTES = 6
"""Bytes of a bigram's hash that are sent besides its range; two bigrams of a range share them far more seldom than the filter errs."""


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's lower-cased words and one end, and where each text's begin."""
    starts, ends, first = block.words()
    words = word_hash(lowered(block.data), starts, ends)
    at = np.arange(len(words)) + np.repeat(np.arange(block.n), np.diff(first))
    out = np.full(len(words) + block.n, END, np.uint64)
    out[at] = words
    return out, first + np.arange(block.n + 1)


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _SECOND + right)


class Counts:
    """Counts of a task, of training texts and of all, given out when they grow beyond `limit` keys; Spark adds up what tasks give out."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.parts, self.waiting = limit, [], 0

    def add(self, keys: np.ndarray, train: np.ndarray) -> bool:
        names, which = np.unique(keys, return_inverse=True)
        self.parts.append((names, np.stack([np.bincount(which, train, len(names)), np.bincount(which, minlength=len(names))], 1).astype(np.int64)))
        self.waiting += len(names)
        if self.waiting > 2 * self.limit:
            self._fold()
        return self.waiting > self.limit

    def _fold(self) -> None:
        keys, times = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
        self.parts = [(keys[at], np.add.reduceat(times, at) if len(at) else times)]
        self.waiting = len(at)

    def give(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self._fold()
            keys, times = self.parts[0]
            self.parts, self.waiting = [], 0
            for low in range(0, len(keys), 1 << 17):
                some = slice(low, low + (1 << 17))
                yield pa.record_batch({"key": column(keys[some]), "c": column(times[some, 0].copy()), "a": column(times[some, 1].copy())})


class Table:
    """A sorted table of keys and values."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def place(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, -1 for absent ones."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its value or 0."""
        at = self.place(keys)
        if not len(self.keys):
            return at >= 0, np.zeros(len(keys), self.values.dtype)
        return at >= 0, np.where(at >= 0, self.values[at], 0)


def steps_of(counts: np.ndarray) -> np.ndarray:
    """The step of each count from 1 up on the logarithmic scale that all counts share; 0 for none."""
    return np.where(counts > 0, 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(STEP) + 1e-9).astype(np.int64), 0)


def value_of(steps: np.ndarray) -> np.ndarray:
    """The least count of a step."""
    return np.where(steps > 0, STEP ** (steps - 1.0), 0.0)


class Filter:
    """Bloom filter of (key, step): a key is in it once for every step up to its count's."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bits_per_entry: int = BITS_PER_ENTRY):
        steps = steps_of(counts)
        bits = max(64, int(steps.sum()) * bits_per_entry)
        self.mask = np.uint64((1 << (bits - 1).bit_length()) - 1)
        flags = np.zeros(int(self.mask) + 1, bool)
        for step in range(1, int(steps.max(initial=0)) + 1):
            some = keys[steps >= step]
            for probe in range(PROBES):
                flags[self.place(some, step, probe).astype(np.int64)] = True
        self.data = np.packbits(flags, bitorder="little")

    def place(self, keys: np.ndarray, step: int, probe: int) -> np.ndarray:
        one = mix(keys + np.uint64(step * int(_SECOND) % (1 << 64)))
        return (one + np.uint64(probe) * (mix(one) | np.uint64(1))) & self.mask

    def read(self, keys: np.ndarray) -> np.ndarray:
        """The counts' lower steps, 0 for absent keys: a key goes on to the next probe and step while its bits are set."""
        found = np.zeros(len(keys), np.int64)
        left, step = np.arange(len(keys)), 0
        while len(left):
            step += 1
            for probe in range(PROBES):
                place = self.place(keys[left], step, probe)
                bit = (self.data[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
                left = left[bit > 0]
            found[left] = step
        return value_of(found)


class Model:
    """What every worker gets: the tokens and bigrams that make up a fixed share of all, and the totals."""

    def __init__(self, total: int, distinct: int, tokens: Table, frequent: np.ndarray, bigrams: Filter, bits_per_entry: int):
        self.total, self.distinct, self.tokens, self.frequent, self.bigrams = total, distinct, tokens, frequent, bigrams
        self.bits_per_entry = bits_per_entry

    def share(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1.0) / (self.total + self.distinct + 1.0)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10(self.share(counts))

    def room(self, counts: np.ndarray) -> np.ndarray:
        return np.log10(SMOOTHING / (counts + SMOOTHING))

    def gain(self, q: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.log10(1.0 + q / (SMOOTHING * self.share(counts)))

    def is_frequent(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return np.zeros(len(keys), bool)
        return self.frequent[np.minimum(np.searchsorted(self.frequent, keys), len(self.frequent) - 1)] == keys


def trains(batch: pa.RecordBatch, block: Block) -> np.ndarray:
    return ~batch.column("held_out").slice(block.first, block.n).to_numpy(zero_copy_only=False)


def counted(docs: DataFrame, among: np.ndarray | None = None) -> DataFrame:
    """key, c (times in training texts) and a (in all) of the tokens; with `among`, of the bigrams of two of these tokens."""
    prepare(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, some = Counts(), None if among is None else Table(among, among)
        for batch in batches:
            for block in blocks(batch):
                keys, first = tokens(block)
                train = np.repeat(trains(batch, block), np.diff(first))
                if some is not None:
                    inside = some.place(keys) >= 0
                    second = inside.copy()
                    second[first[:-1]] = False
                    at = np.flatnonzero(second)
                    at = at[inside[at - 1]]
                    keys, train = pair(keys[at - 1], keys[at]), train[at]
                if counts.add(keys, train):
                    yield from counts.give()
        yield from counts.give()

    return docs.select("text", "held_out").mapInArrow(work, "key long, c long, a long").groupBy("key").agg(
        F.sum("c").alias("c"), F.sum("a").alias("a"))


def collected(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The keys and counts of a table whose number of rows is bounded by a share."""
    table = rows.select("key", "c").toArrow()
    return table.column("key").to_numpy().view(np.uint64), table.column("c").to_numpy()


def fit(docs: DataFrame) -> tuple[Model, int]:
    """What workers get (docs: text, held_out), and the number of all tokens."""
    counts = materialize(counted(docs), "tokens")
    total, distinct, whole = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.coalesce(F.sum("a"), F.lit(0))).first()
    known = Table(*collected(counts.filter(F.col("a") >= whole / TOKEN_SHARE)))
    # A frequent bigram's tokens are at least as frequent; there are no more than PAIR_SHARE of them.
    top = collected(counts.filter(F.col("a") >= whole / PAIR_SHARE))[0]
    discard(counts)
    frequent, times = collected(counted(docs, np.sort(top)).filter(F.col("a") >= whole / PAIR_SHARE))
    return Model(total, distinct, known, np.sort(frequent), Filter(frequent, times, BITS_PER_ENTRY), BITS_PER_ENTRY), whole


def packed(keys: np.ndarray, others: np.ndarray, width: int, rows: np.ndarray, times: np.ndarray, train: np.ndarray) -> bytes:
    """Bigrams of one block and range as bytes. Numbers that are mostly small go byte plane by byte plane, which packs well."""
    part = lambda x, n: np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()
    planes = lambda x: x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
    return part(keys, _KEY_BYTES) + part(others, width) + planes(rows) + planes(times) + train.astype(np.uint8).tobytes()


def unpacked(data: bytes, n: int, width: int) -> tuple[np.ndarray, ...]:
    raw, at = np.frombuffer(data, np.uint8), 0

    def part(size: int) -> np.ndarray:
        nonlocal at
        out = np.zeros((n, 8), np.uint8)
        out[:, :size] = raw[at : at + n * size].reshape(n, size)
        at += n * size
        return out.view(np.uint64).ravel()

    def planes() -> np.ndarray:
        nonlocal at
        out = np.ascontiguousarray(raw[at : at + 4 * n].reshape(4, n).T).view(np.uint32).ravel()
        at += 4 * n
        return out.view(np.int32)

    return part(_KEY_BYTES), part(width), planes(), planes(), raw[at : at + n].astype(bool)


KNOWN, RARE = 4, 8
"""Bytes that go with a bigram whose second token is known to the workers (its place) or not (its hash); 0 marks what is about texts."""
SENT = "range int, block long, width int, n int, data binary"
TEXT = np.dtype([("doc", np.int64), ("no_doc", np.bool_), ("held_out", np.bool_), ("n", np.int64), ("known", np.int64), ("base", np.float64), ("more", np.float64)])
MORE = np.dtype([("row", np.int32), ("more", np.float64)])
REST = np.dtype([("row", np.int32), ("known", np.int32), ("base", np.float64)])


def sent_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    names = [c.split()[0] for c in SENT.split(", ")]
    return pa.record_batch({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(zip(names, kinds))})


def sent(block: Block, batch: pa.RecordBatch, model: Model, ranges: int) -> Iterator[tuple]:
    """What one block sends: its texts with all that is known of them here, and the bigrams of each range."""
    keys, first = tokens(block)
    owner = np.repeat(np.arange(block.n), np.diff(first))
    train = trains(batch, block)
    places = model.tokens.place(keys)
    known = places >= 0
    count = np.where(known, model.tokens.values[places], 0) if len(model.tokens.values) else np.zeros(len(keys), np.int64)
    follows = np.ones(len(keys), bool)
    follows[first[:-1]] = False
    pairs = np.zeros(len(keys), np.uint64)  # 0: the first token of a text
    at = np.flatnonzero(follows)
    pairs[at] = np.maximum(pair(keys[at - 1], keys[at]), np.uint64(1))
    frequent = follows & known & model.is_frequent(pairs)
    more = np.zeros(len(keys))
    more[known & (keys != END)] = model.room(count[known & (keys != END)])
    some = np.flatnonzero(frequent)
    more[some] += model.gain(model.bigrams.read(pairs[some]), count[some])
    texts = np.zeros(block.n, TEXT)
    ids = batch.column("doc_id").slice(block.first, block.n)
    texts["doc"], texts["no_doc"], texts["held_out"] = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), ~train
    texts["n"], texts["known"] = np.diff(first), np.bincount(owner, known & (count > 0), block.n)
    texts["base"], texts["more"] = np.bincount(owner, np.where(known, model.base(count), 0), block.n), np.bincount(owner, more, block.n)
    name = int(batch.column("row")[block.first].as_py())
    yield name % ranges, name, 0, block.n, texts.tobytes()

    for width, chosen in ((KNOWN, known & follows & ~frequent), (RARE, ~known)):
        at = np.flatnonzero(chosen)
        other = places[at].astype(np.uint64) if width == KNOWN else keys[at]
        place = (mix((pairs[at] if width == KNOWN else other) + _SECOND) % np.uint64(ranges)).astype(np.int64)
        # In the order of range, text and bigram; equal ones once with their number.
        order = np.lexsort((pairs[at], owner[at], place))
        at, other, place = at[order], other[order], place[order]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (place[1:] != place[:-1]) | (owner[at[1:]] != owner[at[:-1]]) | (pairs[at[1:]] != pairs[at[:-1]]) | (other[1:] != other[:-1])
        start = np.flatnonzero(fresh)
        times = np.diff(np.append(start, len(at)))
        at, other, place = at[start], other[start], place[start]
        held, lows = np.unique(place, return_index=True)
        for r, low, high in zip(held.tolist(), lows.tolist(), [*lows[1:].tolist(), len(place)]):
            rows = owner[at[low:high]]
            yield r, name, width, high - low, packed(pairs[at[low:high]], other[low:high], width, rows, times[low:high], train[rows])


def shard_sums(table: pa.Table, model: Model) -> pa.Table:
    """One range: counts the training bigrams, builds the shard, probes it for every bigram, and sums per block and text."""
    kinds = table.column("width").to_numpy()
    block, n, data = table.column("block").to_numpy(), table.column("n").to_numpy(), table.column("data")
    out = [(0, int(block[i]), 0, int(n[i]), data[int(i)].as_py()) for i in np.flatnonzero(kinds == 0)]
    parts = []
    for i in np.flatnonzero(kinds > 0):
        key, other, row, times, train = unpacked(data[int(i)].as_py(), int(n[i]), int(kinds[i]))
        parts.append((np.full(len(key), i, np.int32), key, other, row, times, train))
    if parts:
        chunk, key, other, row, times, train = (np.concatenate(x) for x in zip(*parts))
        del parts
        rare = kinds[chunk] == RARE
        names, which = np.unique(key, return_inverse=True)
        counts = np.bincount(which, times * train, len(names)).astype(np.int64)
        real = (names > 0) & (counts > 0)
        q = Filter(names[real], counts[real], model.bits_per_entry).read(names)
        q[names == 0] = 0
        count = np.zeros(len(key), np.int64)
        if len(model.tokens.values):
            count[~rare] = model.tokens.values[other[~rare].astype(np.int64)]
        words, same = np.unique(other[rare], return_inverse=True)
        count[rare] = np.bincount(same, times[rare] * train[rare], len(words)).astype(np.int64)[same] if len(words) else 0
        more = model.gain(q[which], count)
        ends = rare & (other == END)
        more[rare & ~ends] += model.room(count[rare & ~ends])
        place = (chunk.astype(np.int64) << 32) + row
        del chunk, key, other, names, which, q, row
        each, at = np.unique(place, return_inverse=True)
        sums, rest = np.zeros(len(each), MORE), np.zeros(len(each), REST)
        sums["row"] = rest["row"] = each & 0xFFFFFFFF
        sums["more"] = np.bincount(at, more * times, len(each))
        rest["base"] = np.bincount(at, np.where(rare, model.base(count), 0) * times, len(each))
        rest["known"] = np.bincount(at, times * (rare & (count > 0)), len(each))
        bounds = np.searchsorted(each >> 32, np.arange(len(kinds) + 1))
        for i in np.flatnonzero(np.diff(bounds)):
            own = slice(bounds[i], bounds[i + 1])
            out.append((0, int(block[i]), KNOWN, int(bounds[i + 1] - bounds[i]), sums[own].tobytes()))
            if kinds[i] == RARE:
                out.append((0, int(block[i]), RARE, int(bounds[i + 1] - bounds[i]), rest[own].tobytes()))
    return pa.Table.from_batches([sent_batch(out)])


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def block_scores(table: pa.Table) -> pa.Table:
    """One block: its texts with all sums."""
    kinds, data = table.column("width").to_numpy(), table.column("data")
    texts = np.frombuffer(data[int(np.flatnonzero(kinds == 0)[0])].as_py(), TEXT).copy()
    for kind, what in ((KNOWN, MORE), (RARE, REST)):
        parts = [np.frombuffer(data[int(i)].as_py(), what) for i in np.flatnonzero(kinds == kind)]
        if parts:
            each = np.sort(np.concatenate(parts), order=what.names)  # so that the order of arrival doesn't matter
            for name in what.names[1:]:
                np.add.at(texts[name], each["row"], each[name])
    return pa.table({
        "doc_id": pa.array(texts["doc"], pa.int64(), mask=texts["no_doc"]), "held_out": pa.array(texts["held_out"]), "n_tokens": pa.array(texts["n"]),
        "n_known": pa.array(texts["known"]), "base_score": pa.array(texts["base"]), "score": pa.array(texts["base"] + texts["more"])})


def score(docs: DataFrame, folds: int = 7, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of `docs`.

    A row is held out if crc32(doc_id as text) mod `folds` is `held_out`; a null id never is. A null or empty text is its end
    token alone. Without training texts every base share is 1, and both scores are 0. Repeated rows are scored, and count, as
    often as they come. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(crc_of(F.col("doc_id")) % folds == held_out, F.lit(False)).alias("held_out"), "text")
    model, whole = fit(rows)
    ranges = max(1, -(-whole // RANGE_TOKENS))
    shared = spark.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                yield sent_batch(list(sent(block, batch, shared.value, ranges)))

    packets = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(work, SENT)
    sums = packets.groupBy("range").applyInArrow(lambda table: shard_sums(table, shared.value), SENT)
    scored = sums.groupBy("block").applyInArrow(block_scores, SCORES)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
