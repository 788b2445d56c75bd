"""Mixing and the pipeline."""

from __future__ import annotations

import itertools
import random

import corpus_pipeline
import pytest
from shelfline.llm import mixing, stages
from tests.conftest import SMALL


def test_targets_are_shared_and_stop():
    assert mixing.targets([]) == []
    assert mixing.targets([10]) == [10.0]
    assert mixing.targets([0, 0]) == [0.0, 0.0]
    for sizes in ([1, 1, 1000], [5, 100, 100, 0, 7], [1, 2, 3, 4, 5, 6, 7, 1000]):
        got = mixing.targets(sizes)
        assert sum(got) == pytest.approx(sum(sizes))
        assert all(t <= 3 * s + 1e-9 for t, s in zip(got, sizes))
        free = [t / (1 + i % 3) for i, (t, s) in enumerate(zip(got, sizes)) if t < 3 * s - 1e-9]
        assert max(free) == pytest.approx(min(free))


def cost_of(pattern_words, distinct):
    cost, given = 0, 0
    while pattern_words > 0:
        step = distinct * max(1, given)
        cost += given * min(step, pattern_words)
        pattern_words -= step
        given += max(1, given)
    return cost


def test_the_flow_is_the_cheapest():
    r = random.Random(4)
    for _ in range(30):
        distinct = {"0": r.randint(1, 4), "1": r.randint(1, 4), "0,1": r.randint(1, 4)}
        cells = {("0", 0): distinct["0"], ("1", 1): distinct["1"], ("0,1", 0): distinct["0,1"], ("0,1", 1): distinct["0,1"]}
        quotas = [r.randint(0, 3 * (cells["0", 0] + cells["0,1", 0])), r.randint(0, 3 * (cells["1", 1] + cells["0,1", 1]))]
        flow = mixing.route(cells, distinct, quotas)
        assert all(0 <= flow[c] <= 3 * cells[c] for c in cells)
        assert [flow["0", 0] + flow["0,1", 0], flow["1", 1] + flow["0,1", 1]] == quotas
        price = lambda a, b: (
            cost_of(quotas[0] - a, distinct["0"]) + cost_of(quotas[1] - b, distinct["1"]) + cost_of(a + b, distinct["0,1"]))
        best = min(
            price(a, b) for a, b in itertools.product(range(3 * distinct["0,1"] + 1), repeat=2)
            if 0 <= quotas[0] - a <= 3 * distinct["0"] and 0 <= quotas[1] - b <= 3 * distinct["1"])
        assert price(flow["0,1", 0], flow["0,1", 1]) == best


def test_mix_of_overlapping_sources(documents):
    r = random.Random(2)
    shared = [" ".join(f"s{i}w{j}" for j in range(r.randint(5, 40))) for i in range(60)]
    rows = [(i, shared[i % 60], "abc"[i % 3]) for i in range(180)]
    rows += [(200 + i, " ".join(f"o{i}w{j}" for j in range(r.randint(1, 60))), "abc"[i % 2]) for i in range(300)]
    rows += [(900, None, None), (901, "", "empty"), (None, "word", None), (200, rows[180][1], "a")]
    docs = documents(rows)
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for g in got:
        assert g.taken == 0 or (g.taken % g.size == 0 and g.taken <= 3 * g.size)
        by.setdefault(g.source, []).append(g)
    for source, own in by.items():
        assert own[0].source_size == sum(g.size for g in own)
        assert abs(sum(g.taken for g in own) - own[0].target) <= max(3, 0.02 * own[0].target)
    again = mixing.mixed(docs.repartition(7)).collect()
    key = lambda g: (str(g.doc_id), str(g.source), g.size, g.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_every_pattern_is_a_node_of_the_flow(documents, monkeypatch):
    r = random.Random(8)
    held = [(f"text {i} " * r.randint(1, 9), p) for i, p in enumerate(
        p for size in (1, 2, 3, 4, 5) for p in itertools.combinations(range(9), size) for _ in range(2 if size == 1 else 1))]
    held += [(t, p * 3) for t, p in held[:4]]  # copies inside a source are not distinct words
    rows = [(i, t, "abcdefghi"[s]) for i, (t, s) in enumerate((t, s) for t, p in held for s in p)]
    sources, cells, distinct = {}, {}, {}
    for _, t, s in rows:
        sources.setdefault(t, set()).add("abcdefghi".index(s))
    name = {t: ",".join(map(str, sorted(p, key=int))) for t, p in sources.items()}
    for _, t, s in rows:
        cell = name[t], "abcdefghi".index(s)
        cells[cell] = cells.get(cell, 0) + len(t.split())
    for t, p in name.items():
        distinct[p] = distinct.get(p, 0) + len(t.split())
    assert len(distinct) > 256 + 9
    flow, route = {}, mixing.route

    def watched(*given):
        assert given[:2] == (cells, distinct)
        return flow.setdefault(0, route(*given))

    monkeypatch.setattr(mixing, "route", watched)
    monkeypatch.setattr(mixing, "ROUNDS", 0)
    got, taken = mixing.mixed(documents(rows)).collect(), dict.fromkeys(cells, 0)
    for g in got:
        _, t, s = rows[g.doc_id]
        taken[name[t], "abcdefghi".index(s)] += g.taken
    assert len(got) == len(rows) and all(0 <= flow[0][c] - w < 40 for c, w in taken.items())


def test_the_mix_repeats_whole_rows(documents):
    docs = documents([(i, " ".join(f"w{i}x{j}" for j in range(20)), "ab"[i % 2]) for i in range(60)])
    plan = {g.doc_id: g.taken // g.size for g in mixing.mixed(docs).collect()}
    mix = mixing.repeat(docs)
    assert mix.columns == docs.columns
    times = {r.doc_id: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert times == {i: n for i, n in plan.items() if n}
    assert mixing.mixed(documents([])).count() == 0 and mixing.repeat(documents([])).count() == 0


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stages.reread(stage(spark, kept, SMALL))
        assert kept.columns == docs.columns
        if name != "mixing":
            assert kept.count() <= before.count() and kept.exceptAll(before).isEmpty()
    tokens = corpus_pipeline.STAGES[-1][1](spark, kept, SMALL)
    assert tokens.count() == kept.count() and tokens.filter("n_tokens != size(ids)").isEmpty()
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(str, whole.collect())) == sorted(map(str, tokens.collect()))
