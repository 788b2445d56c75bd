"""Sharding, byte-level BPE and token counts against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from shelfline.llm import bpe, sharding, token_counts
from shelfline.llm.queries import VOCABULARY
from shelfline.session import materialize


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.Vocabulary.load(VOCABULARY).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_shards_are_contiguous_and_balanced(documents):
    r = random.Random(1)
    rows = [(i, "x" * r.randint(0, 400)) for i in range(2000)] + [(5, None), (None, "y"), (5, "x")]
    got = sharding.shard(documents(rows), 8).collect()
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=lambda k: (k[0] is not None, k[0] or 0, k[1], k[2]))
    whole, before, shards = sum(k[1] for k in want), 0, [[] for _ in range(8)]
    for key in want:
        shards[min(7, (2 * before + key[1]) * 8 // (2 * whole))].append(key)
        before += key[1]
    for s, keys in enumerate(shards):
        own = sorted((g for g in got if g.shard == s), key=lambda g: g.slot)
        assert [(g.doc_id, g.size, g.text_crc32) for g in own] == keys
        assert [g.slot for g in own] == list(range(len(keys)))
        assert abs(sum(k[1] for k in keys) - whole / 8) <= 401


def test_written_shards_hold_every_row(documents, spark, tmp_path):
    docs = documents([(i, f"text {i}" * (i % 7)) for i in range(300)], extra=False)
    sharding.write_shards(docs, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    placed = {(r.doc_id, r.shard) for r in sharding.shard(docs, 4).collect()}
    assert {(r.doc_id, r.shard) for r in back.collect()} == placed
    assert sorted(r.text for r in back.collect()) == sorted(r.text for r in docs.collect())


def test_shards_of_few_or_no_rows(documents):
    assert sharding.shard(documents([])).count() == 0
    assert [(r.shard, r.slot) for r in sharding.shard(documents([(1, "a")])).collect()] == [(4, 0)]


def test_perfect_hash_is_minimal_and_perfect():
    words = bpe.Vocabulary.load(VOCABULARY)
    assert (words.whole(bpe.hash_tokens(words.tokens)) == words.ids).all()
    assert sorted(words.slot_id.tolist()) == sorted(words.ids.tolist())
    assert (words.whole(bpe.hash_tokens([b"no such token in it", b"\xff\xff\xff"])) == -1).all()


def test_encoding_is_that_of_the_library(documents, odd_rows, reference):
    r = random.Random(3)
    alphabet = "aAsStrRvVeElLmdD''''  \n\t\r 　 12²Ⅷ!?.é中😀́ǅ\x1c\x85​"
    rows = [*odd_rows, *((100 + i, "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))) for i in range(800)), (50, "a" * 3000)]
    got = bpe.encode(documents(rows), VOCABULARY).collect()
    assert sorted((str(g.doc_id), list(g.ids)) for g in got) == sorted((str(i), reference.encode_ordinary(t or "")) for i, t in rows)


def test_round_trip(documents, odd_rows, reference):
    docs = documents(odd_rows)
    back = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY).collect()
    assert sorted((str(b.doc_id), b.text) for b in back) == sorted((str(i), t or "") for i, t in odd_rows)
    digests = bpe.round_trip(docs, VOCABULARY).collect()
    want = []
    for i, t in odd_rows:
        ids = reference.encode_ordinary(t or "")
        want.append((str(i), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((str(d.doc_id), d.n_tokens, d.ids_sha256, d.decoded_sha256) for d in digests) == sorted(want)
    assert bpe.round_trip(documents([]), VOCABULARY).count() == 0


def test_documents_are_counted_from_flat_files(documents, odd_rows, reference):
    docs = materialize(documents(odd_rows).repartition(3), "docs")
    got = token_counts.count_documents(docs, VOCABULARY).collect()
    assert sorted((str(g.doc_id), g.n_tokens) for g in got) == sorted((str(i), len(reference.encode_ordinary(t or ""))) for i, t in odd_rows)
    assert token_counts.count_documents(documents([]), VOCABULARY).count() == 0


@pytest.mark.parametrize("block_bytes", [2, 6, 64, 1 << 20])
def test_blocks_are_stitched(spark, tmp_path, block_bytes):
    r, want = random.Random(block_bytes), {}
    for f in range(4):
        lengths = [r.choice([0, 0, 1, 3, 50]) for _ in range(30)]
        ids = [i for n in lengths for i in [*(r.randrange(50000) for _ in range(n)), token_counts.SEPARATOR]]
        if f == 1:
            ids += [1, 2, 3]
            lengths.append(3)
        if f == 2:
            ids, lengths = [], []
        if f == 3:
            ids, lengths = [9] * 70, [70]  # no separator at all
        (tmp_path / f"flat-{f}.bin").write_bytes(np.array(ids, "<u2").tobytes())
        want |= {(f, k): n for k, n in enumerate(lengths)}
    got = token_counts.count_tokens(token_counts.read_blocks(spark, str(tmp_path), block_bytes)).collect()
    assert {(int(g.file[-5]), g.ordinal): g.n_tokens for g in got} == want
    assert sum(not g.ended for g in got) == 2
