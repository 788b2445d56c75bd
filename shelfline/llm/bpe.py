"""Byte-level BPE in two tiers.

A pre-token that is itself in the vocabulary is resolved by a minimal perfect hash, for all pre-tokens of a block at once. The
others are merged by a heap over linked bytes; each worker remembers a bounded number of them. Pre-tokens are split as by
`'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`, by runs of character classes.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.text import Block, blocks, column, mix, prepare, span_hash

REMEMBERED = 1 << 18
KEYS_PER_BUCKET = 4

# The code points of Unicode's White_Space property.
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SPACE, LETTER, NUMBER, OTHER = range(4)


@functools.cache
def character_classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[list(WHITE_SPACE)] = SPACE
    return table


def hash_tokens(tokens: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(tokens), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
    return span_hash(Block(data, offsets, 0).prefix(), offsets[:-1], offsets[1:])


def minimal_perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements by bucket, and the key's index by slot: as many slots as keys, each key in its own.

    Buckets are placed from the largest; a bucket of one key names a free slot directly, as a negative displacement.
    """
    n, buckets = len(keys), len(keys) // KEYS_PER_BUCKET + 1
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    moves, slots = np.zeros(buckets, np.int64), np.full(n, -1, np.int64)
    for b in np.argsort(-sizes, kind="stable"):
        members = order[begin[b] : begin[b + 1]]
        if len(members) < 2:
            break
        for base in itertools.count(1, 256):
            tries = np.arange(base, base + 256)
            places = displaced(keys[members][None, :], tries[:, None], n)
            fits = (slots[places] < 0).all(1)
            for i in np.flatnonzero(fits):
                if len(set(places[i])) == len(members):
                    moves[b], slots[places[i]] = tries[i], members
                    break
            else:
                continue
            break
    free = iter(np.flatnonzero(slots < 0))
    for b in np.flatnonzero(sizes == 1):
        slot = next(free)
        moves[b], slots[slot] = -1 - slot, order[begin[b]]
    return moves, slots


def displaced(keys: np.ndarray, moves: np.ndarray, n: int) -> np.ndarray:
    return (mix(keys ^ (moves.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(n)).astype(np.int64)


class Vocabulary:
    """Ranks of a public vocabulary, with its perfect hash. Its size is that of the vocabulary file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = sorted(ranks, key=ranks.get)
        self.ids = np.array([ranks[t] for t in self.tokens], np.int32)
        keys = hash_tokens(self.tokens)
        self.moves, slots = minimal_perfect_hash(keys)
        self.slot_key, self.slot_id = keys[slots], self.ids[slots]
        self.text = np.full(self.ids.max() + 1, "", object)
        self.text[self.ids] = [str(i) for i in self.ids.tolist()]
        by_id = [b""] * len(self.text)
        for token, i in ranks.items():
            by_id[i] = token
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for t in by_id])])
        self.remembered = functools.lru_cache(REMEMBERED)(self.merge)

    def __reduce__(self):
        return Vocabulary, (self.ranks,)

    @staticmethod
    @functools.cache
    def load(path: str) -> Vocabulary:
        """Reads a file of base64 tokens and ranks."""
        with open(path, "rb") as lines:
            return Vocabulary({base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)})

    def whole(self, keys: np.ndarray) -> np.ndarray:
        """Ids of the pre-tokens that are tokens, -1 for others. The key found is compared with the key sought."""
        moves = self.moves[(keys % np.uint64(len(self.moves))).astype(np.int64)]
        slots = np.where(moves < 0, -1 - moves, displaced(keys, np.maximum(moves, 0), len(self.slot_key)))
        return np.where(self.slot_key[slots] == keys, self.slot_id[slots], -1)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Joins the neighbours with the lowest rank, the leftmost first, until no neighbours form a token."""
        n, ranks = len(piece), self.ranks
        after, before = list(range(1, n + 2)), list(range(-1, n))
        rank_at: list[int | None] = [ranks.get(piece[i : i + 2]) for i in range(n - 1)] + [None]
        heap = [r * n + i for i, r in enumerate(rank_at) if r is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            if rank_at[i] != rank:
                continue  # a neighbour has been joined since
            gone = after[i]
            end = after[gone]
            after[i] = end
            rank_at[gone] = None
            if end < n:
                before[end] = i
                r = rank_at[i] = ranks.get(piece[i : after[end]])
                if r is not None:
                    heapq.heappush(heap, r * n + i)
            else:
                rank_at[i] = None
            left = before[i]
            if left >= 0:
                r = rank_at[left] = ranks.get(piece[left:end])
                if r is not None:
                    heapq.heappush(heap, r * n + left)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return tuple(out)

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts of the block, and where each text's begin."""
        starts, first = pretokens(block)
        ends = np.append(starts[1:], len(block.data))
        keys = span_hash(block.prefix(), starts, ends)
        ids = self.whole(keys)
        missed = np.flatnonzero(ids < 0)
        _, example, which = np.unique(keys[missed], return_index=True, return_inverse=True)
        raw, at = block.data.tobytes(), missed[example]
        merged = [self.remembered(raw[a:b]) for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        lengths = np.fromiter(map(len, merged), np.int64, len(merged))
        flat = np.fromiter(itertools.chain.from_iterable(merged), np.int32, int(lengths.sum()))
        count = np.ones(len(ids), np.int64)
        count[missed] = lengths[which]
        place = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(place[-1], np.int32)
        found = ids >= 0
        out[place[:-1][found]] = ids[found]
        source = np.concatenate([[0], np.cumsum(lengths)])[:-1][which]
        many = lengths[which]
        steps = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        out[np.repeat(place[missed], many) + steps] = flat[np.repeat(source, many) + steps]
        return out, place[first]

    def decode(self, ids: np.ndarray) -> bytes:
        begin = self.bounds[ids]
        lengths = self.bounds[ids + 1] - begin
        steps = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return self.flat[np.repeat(begin, lengths) + steps].tobytes()


def pretokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of all pre-tokens, which cover the texts without gaps, and where each text's begin in them."""
    points = np.frombuffer(block.data.tobytes().decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(block.n + 1, np.int64)
    width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000).astype(np.int64)
    width[(points >= 0xDC80) & (points <= 0xDCFF)] = 1
    at = np.concatenate([[0], np.cumsum(width)])
    texts = np.searchsorted(at, block.offsets)
    fresh = np.zeros(n + 1, bool)
    fresh[texts] = True
    kind = character_classes()[points]
    change = fresh[:-1].copy()
    change[0] = True
    change[1:] |= kind[1:] != kind[:-1]
    begin = np.flatnonzero(change)
    end = np.append(begin[1:], n)
    mark = np.zeros(n + 1, bool)
    mark[begin] = True
    # White space before something else in the same text: its last character stands alone or, if a blank, joins what follows.
    inner = (kind[begin] == SPACE) & ~fresh[end]
    last = end[inner] - 1
    mark[last] = True
    mark[last[points[last] == 32] + 1] = False
    # An apostrophe that starts a pre-token and is followed by one of the endings takes that ending with it.
    quote = begin[(end - begin == 1) & (points[begin] == 39)]
    quote = quote[~fresh[quote + 1]]
    quote = quote[fresh[quote] | (points[np.maximum(quote - 1, 0)] != 32)]
    one, two = points[quote + 1], np.where(quote + 2 < n, points[np.minimum(quote + 2, n - 1)], 0)
    two = np.where(fresh[np.minimum(quote + 2, n)], 0, two)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    mark[quote[short | long] + 1] = False
    mark[quote[short] + 2] = True
    mark[quote[long] + 3] = True
    starts = np.flatnonzero(mark[:n])
    return at[starts], np.searchsorted(starts, texts)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of token ids) of every whole text. A null or empty text has no ids."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(Vocabulary.load(path))  # bounded by the vocabulary file

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                ids, first = shared.value.encode(block)
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(block.first, block.n),
                    "ids": pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids))})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of encoded documents; the bytes of each text are those of its tokens in order."""
    spark = encoded.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(Vocabulary.load(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [shared.value.decode(np.array(ids or [], np.int64)).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(work, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by blanks), decoded_sha256 (bytes decoded from the ids)."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(Vocabulary.load(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            for block in blocks(batch):
                ids, first = words.encode(block)
                parts = [ids[a:b] for a, b in itertools.pairwise(first.tolist())]
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(block.first, block.n),
                    "n_tokens": column(np.diff(first).astype(np.int64)),
                    "ids_sha256": [hashlib.sha256(" ".join(words.text[p].tolist()).encode()).hexdigest() for p in parts],
                    "decoded_sha256": [hashlib.sha256(words.decode(p)).hexdigest() for p in parts]})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
