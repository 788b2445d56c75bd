"""The pipeline after its trained stage, and registered queries on a written table, against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from shelfline.llm import bloom_lm, bpe, mixing, queries, stages
from tests.conftest import SMALL
from tests.llm.test_dedup import plain, shingle_set
from tests.llm.test_models import whole_scores, words


def without_copies(rows):
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(plain(r.text), r)
    return list(first.values())


def without_near_copies(rows):
    rows = sorted(rows, key=lambda r: r.doc_id)
    sets, root = [shingle_set(r.text) for r in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if x == high else x for x in root]
    return [r for i, r in enumerate(rows) if root[i] == i]


def prefix(rows, quota, sizes, order):
    """The first of the rows in seeded order while their sizes add up to no more than the quota."""
    out, given = [], 0
    for i in sorted(rows, key=lambda i: order[i] % (1 << 64)):
        given += sizes[i]
        if given > quota:
            break
        out.append(i)
    return out


def times_in_the_mix(rows, orders):
    sizes = {r.doc_id: len(words(r.text)) for r in rows}
    names = sorted({r.source for r in rows})
    source = {r.doc_id: names.index(r.source) for r in rows}
    holders, cells, distinct = defaultdict(set), defaultdict(list), Counter()
    for r in rows:
        holders[r.text].add(source[r.doc_id])
    pattern = {text: ",".join(map(str, sorted(p))) for text, p in holders.items()}
    for r in rows:
        cells[pattern[r.text], source[r.doc_id]].append(r.doc_id)
    for text, p in pattern.items():
        distinct[p] += len(words(text))
    goals = mixing.targets([sum(sizes[i] for i in sizes if source[i] == s) for s in range(len(names))])
    held = {cell: sum(sizes[i] for i in ids) for cell, ids in cells.items()}
    flow, times = mixing.route(held, dict(distinct), [round(g) for g in goals]), Counter()
    for cell, ids in cells.items():
        if held[cell]:
            each, rest = divmod(flow[cell], held[cell])
            times.update({i: each for i in ids})
            times.update(prefix([i for i in ids if sizes[i]], rest, sizes, orders[0]))
    for turn in range(mixing.ROUNDS):
        more = []
        for s, goal in enumerate(goals):
            gap = round(goal) - sum(times[i] * sizes[i] for i in sizes if source[i] == s)
            if gap > mixing.NEAR * goal:
                fit = [i for i in sizes if source[i] == s and 0 < sizes[i] <= gap and times[i] < mixing.MOST]
                more += prefix(fit, gap, sizes, orders[1 + turn])
        times.update(more)
    return times


def test_stages_after_the_first_against_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    clean = stages.reread(corpus_pipeline.STAGES[0][1](spark, docs, SMALL))
    rows = without_near_copies(without_copies(clean.collect()))
    seeds = range(mixing.SEED, mixing.SEED + mixing.ROUNDS + 1)
    hashed = clean.select("doc_id", F.array(*(F.xxhash64(F.col("doc_id").cast("long"), mixing.digest(), F.lit(s)) for s in seeds)).alias("h"))
    hashes = {r.doc_id: r.h for r in hashed.collect()}
    times = times_in_the_mix(rows, [{i: h[turn] for i, h in hashes.items()} for turn in range(len(seeds))])
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.Vocabulary.load(queries.VOCABULARY).ranks, special_tokens={})
    want = Counter({(r.doc_id, tuple(encoding.encode_ordinary(r.text))): times[r.doc_id] for r in rows if times[r.doc_id]})
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter((g.doc_id, tuple(g.ids)) for g in got) == want
    assert all(g.n_tokens == len(g.ids) for g in got)


def test_queries_on_a_written_table(spark, documents, odd_rows, tmp_path, monkeypatch):
    documents(odd_rows).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(bloom_lm, "BITS_PER_ENTRY", 40)
    got = sorted((str(g.doc_id), g.score) for g in queries.QUERIES["op6_bloom_lm"](spark, str(tmp_path)).collect())
    want = whole_scores(odd_rows)
    assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-2)
    shards = queries.QUERIES["op3_byte_shards"](spark, str(tmp_path)).collect()
    assert sorted(str(g.doc_id) for g in shards) == sorted(str(i) for i, _ in odd_rows)
    assert all(g.law == "bytes" and g.grown_shard is None and 0 <= g.shard < 8 for g in shards)
    mix = queries.QUERIES["op9_flow_mixing"](spark, str(tmp_path))
    assert not {"source", "digest"} & set(mix.columns)
    assert sorted((str(g.doc_id), g.size) for g in mix.collect()) == sorted((str(i), len(words(t))) for i, t in odd_rows)
