"""Removal of repeated passages against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import queries, substrings
from shelfline.llm.text import word_hash


def brute(rows, width):
    """Per row: words, removed words' numbers."""
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, words in texts:
        for at in range(len(words) - width + 1) if i is not None else ():
            key = tuple(words[at : at + width])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, words in texts:
        gone = set()
        for at in range(len(words) - width + 1) if i is not None else ():
            if least[tuple(words[at : at + width])] < i:
                gone |= set(range(at, at + width))
        out.append((i, words, gone))
    return out


def expected(rows, width):
    return sorted((str(i), len(w), len(g), " ".join(x for k, x in enumerate(w) if k not in g)) for i, w, g in brute(rows, width))


def result(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in df.collect())


def passages(seed=11):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6)))
    shared = [[word() for _ in range(n)] for n in (60, 50, 49, 55, 120)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(r.randint(1, 4)):
            text += [word() for _ in range(r.randint(0, 60))]
            if r.random() < 0.6:
                piece = list(r.choice(shared))
                if r.random() < 0.3:
                    piece[r.randrange(len(piece))] = word()
                text += piece
        rows.append((i, r.choice([" ", "\n", " \t "]).join(text)))
    rows += [(500 + i, rows[i][1]) for i in range(20)]  # exact copies
    rows += [(600 + i, "again and " * 200) for i in range(5)]  # windows that repeat in one text and in others
    rows += [(700, "x " * 49), (701, "x " * 49), (702, "x " * 50), (703, "x " * 51), (704, "x " * 300)]
    rows += [(3, rows[9][1]), (None, rows[4][1]), (None, rows[4][1]), (rows[5][0], rows[5][1])]  # repeated ids and null ids
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("group", [4096, 2])
def test_repeated_passages(documents, monkeypatch, group):
    """With small groups, then with prefixes that have too many stretches for one."""
    monkeypatch.setattr(substrings, "GROUP", group)
    rows = passages()
    assert result(substrings.remove_repeats(documents(rows).repartition(7))) == expected(rows, 50)


@pytest.mark.parametrize("width", [1, 5, 12, 20])
def test_other_widths(documents, width):
    r = random.Random(width)
    rows = [(i, " ".join(r.choice("abcd") for _ in range(r.randint(0, 90)))) for i in range(60)]
    assert result(substrings.remove_repeats(documents(rows), width)) == expected(rows, width)


def test_odd_rows(documents, odd_rows):
    assert result(substrings.remove_repeats(documents(odd_rows))) == expected(odd_rows, 50)
    assert substrings.remove_repeats(documents([])).collect() == []


def test_spans_name_the_removed_words(documents):
    rows = passages(5)[:60]
    want = {(str(i), " ".join(w)): sorted(g) for i, w, g in brute(rows, 50)}
    for r in substrings.remove_repeats(documents(rows)).collect():
        numbers = [k for s in r.spans for k in range(s.begin, s.end)]
        assert len(numbers) == r.n_removed == len(set(numbers))
    assert sum(map(len, want.values())) > 0


def test_registered_query(spark, documents, tmp_path):
    rows = [(i, t) for i, t in passages(8)]
    documents(rows, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op13_suffix_tree_dedup"](spark, str(tmp_path)).collect()
    want = [(i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in expected(rows, 50)]
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(want)


def test_nodes_are_equal_windows():
    words = np.random.default_rng(3).integers(0, 2, 400).astype(np.uint64)
    for width in (1, 2, 7, 8, 50):
        rank = substrings.nodes_at(words, width)
        same = {}
        for at in range(len(words) - width + 1):
            assert same.setdefault(tuple(words[at : at + width]), rank[at]) == rank[at]
        assert len(same) == len(set(rank.tolist()))


def test_word_hash_tells_structured_words_apart():
    """Thue-Morse words of two letters collide under a polynomial modulo a power of two."""
    def morse(n, flip):
        return bytes((97 + (bin(i).count("1") + flip) % 2) for i in range(n))

    for n in (8, 64, 1024, 4096):
        data = np.frombuffer(morse(n, 0) + morse(n, 1) + morse(n, 0), np.uint8)
        a, b, c = word_hash(data, np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n]))
        assert a == c != b


def test_sequences_come_once_without_a_shuffle_of_their_own(spark, documents):
    docs = documents([(1, " ".join(f"w{i}" for i in range(80)))])
    docs = docs.unionByName(docs)
    same = docs.limit(1).select(
        F.struct("doc_id", F.xxhash64("text").alias("text_key"), F.lit(3).cast("long").alias("at")).alias("least"), F.lit(5).alias("n"),
        F.lit(11).cast("long").alias("prefix"), F.lit(12).cast("long").alias("words"), F.lit(2).cast("long").alias("times"),
        F.lit(4).cast("long").alias("hi"), F.lit(2).cast("long").alias("_stretches"))
    found = substrings.sequences_of(docs, same, 50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange")
    assert [(r.prefix, r.lo, len(r.sequence)) for r in found.collect()] == [(11, 1, 54)]
