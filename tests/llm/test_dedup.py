"""Exact and near-duplicates against brute force."""

from __future__ import annotations

import glob
import hashlib
import re
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfline.llm import components, exact_dedup, joins, minhash


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup_of_odd_rows(documents, odd_rows):
    got = exact_dedup.dedup(documents(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    groups = defaultdict(list)
    for i, t in odd_rows:
        groups[hashlib.sha256(plain(t).encode()).hexdigest()].append(i)
    kept = defaultdict(int)
    for row in got:
        ids = groups[row.text_sha256]
        known = [i for i in ids if i is not None]
        assert row.keep_id == (min(known) if known else None)
        assert row.group_size == len(ids)
        assert not row.kept or row.doc_id == row.keep_id
        kept[row.text_sha256] += row.kept
    assert set(kept.values()) == {1}


def test_exact_dedup_keeps_rows_whole(documents, odd_rows):
    docs = documents(odd_rows)
    stay = exact_dedup.drop_copies(docs)
    assert stay.columns == docs.columns
    assert stay.count() == len({plain(t) for _, t in odd_rows})


def test_large_group_of_copies_over_many_partitions(documents):
    rows = [(i, "same text" if i % 3 else f"own text {i}") for i in range(3000)]
    got = exact_dedup.dedup(documents(rows, extra=False).repartition(40)).filter("kept").count()
    assert got == 1001


@pytest.mark.parametrize("partitions", [1, 4, 33])
def test_runs_are_sorted_and_disjoint(spark, documents, partitions):
    rows = [(i if i % 11 else None, "same text" if i % 3 else f"own text {i // 2}") for i in range(2000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        docs = documents(rows, extra=False).repartition(9).select(
            "doc_id", exact_dedup.digest(exact_dedup.normalised()).alias("digest"))
        runs = exact_dedup.merge_runs(docs.groupBy("doc_id", "digest").agg(F.count("*").alias("copies")))
        bits = (partitions - 1).bit_length()
        seen = []
        for file in sorted(glob.glob(f"{runs._written_to}/*.parquet")):
            part = pq.read_table(file).to_pylist()
            digests = [r["digest"] for r in part]
            assert digests == sorted(set(digests))
            assert {r["run"] for r in part} <= {int.from_bytes(d[:4], "big") >> (32 - bits) for d in digests}
            assert len({r["run"] for r in part}) <= 1
            seen += part
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(t.encode()).digest()].append(i)
    assert len(seen) == len(groups)
    for r in seen:
        ids = groups[bytes(r["digest"][:32])]
        assert r["group_size"] == len(ids)
        assert r["n_ids"] == len(set(ids))
        assert r["keep_id"] == min((i for i in ids if i is not None), default=None)
    assert max(len(ids) for ids in groups.values()) > 1000


def test_a_round_merges_where_its_exchange_leaves_the_rows(spark, documents, capsys):
    rows = documents([(1, "a"), (2, "b")], extra=False).select(
        "doc_id", exact_dedup.digest(F.col("text")).alias("digest"), F.lit(1).cast("long").alias("copies"))
    plan = exact_dedup.merged(exact_dedup.sorted_runs(rows, 4), 4)
    plan.explain()
    text = capsys.readouterr().out
    # One exchange deals the runs, two are rounds; none of the aggregates has a hash table.
    assert text.count("Exchange") == 3 and text.count("REPARTITION_BY_NUM") == 2
    assert "HashAggregate" not in text


def test_empty_tables(documents):
    docs = documents([])
    assert exact_dedup.dedup(docs).count() == 0
    assert exact_dedup.drop_copies(docs).count() == 0
    assert minhash.near_duplicates(docs).count() == 0
    assert minhash.drop_near_copies(docs).count() == 0


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a][1] & sets[b][1])
            if common and 100 * common >= 75 * len(sets[a][1] | sets[b][1]):
                root[top(a)] = top(b)
    groups = defaultdict(list)
    for x in range(len(sets)):
        groups[top(x)].append(sets[x][0])
    least = {x: min((i for i in ids if i is not None), default=None) for x, ids in groups.items()}
    return sorted(((i, len(s), least[top(x)]) for x, (i, s) in enumerate(sets)), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_near_duplicates_of_odd_rows(documents, odd_rows):
    got = minhash.near_duplicates(documents(odd_rows))
    assert found(got) == brute(odd_rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_near_duplicates_of_families(documents, families):
    assert found(minhash.near_duplicates(documents(families).repartition(5))) == brute(families)


def test_near_copies_are_dropped_whole(documents, families):
    docs = documents(families)
    stay = minhash.drop_near_copies(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.select("doc_id").collect()) == sorted({c for _, _, c in brute(families)})


def test_components_of_a_long_path_a_star_and_a_loop(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 900)] + [(7, 7), (3, 2), (2, 1), (1, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in range(500, 900)} == {500}
    assert got[1] == got[2] == got[3] == 1 and 7 not in got


def test_may_match_keeps_what_matches_and_little_else(spark):
    rows = spark.range(20000).select(F.xxhash64("id").alias("key"), "id").withColumn("key", F.when(F.col("id") == 7, F.lit(-1)).otherwise(F.col("key")))
    wanted = rows.filter("id % 100 = 7").select(F.col("key").alias("k"))
    wanted = wanted.unionByName(wanted)
    got = [r.id for r in joins.may_match(rows.unionByName(rows.filter("id = 7")), "key", wanted, "k").collect()]
    assert sorted(i for i in got if i % 100 == 7) == [7, *range(7, 20000, 100)]
    assert len(got) < 230
    assert joins.may_match(rows, "key", wanted.limit(0), "k").isEmpty()


def test_texts_that_are_not_wanted_are_not_shuffled(spark, documents):
    docs = documents([(1, "a b c"), (2, "d e f")])
    wanted = docs.filter("doc_id = 2").select(F.lit(9).cast("long").alias("node"), "doc_id", F.xxhash64("text").alias("text_key"))
    sets = minhash.sets_of(docs, wanted)
    assert "getbit" in sets._jdf.queryExecution().executedPlan().toString()
    assert [r.node for r in sets.collect()] == [9]


def test_rows_that_a_join_drops_are_left_out_before_its_shuffle(spark, monkeypatch):
    """Bands that are alone in their bucket, and sets that no comparison reads."""
    kept = []

    def spied(rows, key, wanted, wanted_key, through=minhash.may_match):
        found = through(rows, key, wanted, wanted_key)
        kept.append((key, found.count(), rows.count()))
        return found

    monkeypatch.setattr(minhash, "may_match", spied)
    words = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(i, words(i, 40)) for i in range(60)] + [(100 + i, words(i, 40) + " end") for i in range(3)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in found if not r["kept"]} == {100, 101, 102}
    by_key = {}
    for key, some, every in kept:
        by_key.setdefault(key, []).append((some, every))
    (some, every), = by_key["bucket"]
    assert every == 63 * 40 and some <= 2 * 3 * 40
    assert len(by_key["_place"]) == 3 and all(some <= every for some, every in by_key["_place"])
