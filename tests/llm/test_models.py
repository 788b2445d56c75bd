"""Language model, quality, toxicity and line rules against brute force or held-out labels."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from math import log10
from zlib import crc32

import numpy as np
import pytest

from shelfline.llm import bloom_lm, line_rules, pairwise_quality, queries, toxicity
from shelfline.llm.text import Block
from tests.conftest import SMALL


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def tokens(text):
    return [*(w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)), None]


def held(i, folds, rest):
    return i is not None and crc32(str(i).encode()) % folds == rest


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")


def base_scores(rows):
    counts = Counter(w for i, t in rows if not held(i, 7, 2) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return [(str(i), held(i, 7, 2), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
             sum(log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows]


def check_base(got, rows):
    want = sorted(base_scores(rows))
    got = sorted((str(g.doc_id), g.held_out, g.n_tokens, g.n_known, g.train_tokens, g.base_score) for g in got)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])


def test_base_scores_of_odd_rows(documents, odd_rows):
    check_base(bloom_lm.score(documents(odd_rows)).collect(), odd_rows)
    assert bloom_lm.score(documents([])).count() == 0


def test_scores_of_the_small_table(small):
    rows = [(r.doc_id, r.text) for r in small[0].select("doc_id", "text").collect()]
    got = bloom_lm.score(small[0]).collect()
    check_base(got, rows)
    assert all(np.isfinite(g.score) and g.score <= 0 for g in got)
    apart = [g for g in got if g.held_out]
    assert sum(g.score for g in apart) > sum(g.base_score for g in apart)


def test_rare_tokens_take_the_other_path(documents, monkeypatch):
    monkeypatch.setattr(bloom_lm, "TOKEN_SHARE", 40)
    monkeypatch.setattr(bloom_lm, "PAIR_SHARE", 20)
    rows = [(i, " ".join(f"w{(i * j) % 37 if j % 3 else 0}" for j in range(1, 60))) for i in range(40)]
    check_base(bloom_lm.score(documents(rows)).collect(), rows)


def test_probabilities_add_up_to_no_more_than_one():
    """After any word, over all words of the training texts, from counts as the filter gives them back."""
    r = random.Random(3)
    texts = [[*(f"w{min(r.randrange(30), r.randrange(30))}" for _ in range(80)), None] for _ in range(60)]
    ones, twos = Counter(w for t in texts for w in t), Counter(p for t in texts for p in zip(t, t[1:]))
    n, v, d = sum(ones.values()), len(ones), bloom_lm.SMOOTHING
    quantised = lambda c: float(bloom_lm.value_of(bloom_lm.steps_of(np.array([c])))[0])
    for left in ones:
        if left is not None:
            assert sum((quantised(twos[left, w]) + d * (ones[w] + 1) / (n + v + 1)) / (ones[left] + d) for w in ones) <= 1 + 1e-12


def whole_scores(rows):
    """The model over the quantised counts of all bigrams."""
    texts = [(str(i), held(i, 7, 2), tokens(t)) for i, t in rows]
    ones = Counter(w for _, apart, t in texts if not apart for w in t)
    twos = Counter(p for _, apart, t in texts if not apart for p in zip(t, t[1:]))
    n, v, d = sum(ones.values()), len(ones), bloom_lm.SMOOTHING
    share = lambda w: (ones[w] + 1) / (n + v + 1)
    twos = {p: float(bloom_lm.value_of(bloom_lm.steps_of(np.array([c])))[0]) for p, c in twos.items()}
    return sorted((i, sum(log10(share(w)) for w in t) + sum(
        log10((twos.get((a, b), 0) + d * share(b)) / (ones[a] + d) / share(b)) for a, b in zip(t, t[1:]))) for i, _, t in texts)


@pytest.mark.parametrize("token_share, pair_share, range_tokens", [
    (1 << 20, 1 << 14, 1 << 23), (300, 1, 1 << 23), (1, 1, 5000), (1 << 20, 200, 700), (1 << 20, 1 << 20, 5000)])
def test_where_a_shard_lies_changes_no_score(small, documents, odd_rows, monkeypatch, token_share, pair_share, range_tokens):
    """Every bigram counts however rare; all, some or none frequent, in one range or many, tokens known to workers or not. The
    filter's errors show in few texts."""
    monkeypatch.setattr(bloom_lm, "TOKEN_SHARE", token_share)
    monkeypatch.setattr(bloom_lm, "PAIR_SHARE", pair_share)
    monkeypatch.setattr(bloom_lm, "RANGE_TOKENS", range_tokens)
    monkeypatch.setattr(bloom_lm, "BITS_PER_ENTRY", 40)  # errors have a test of their own
    rows = [(r.doc_id, r.text) for r in small[0].select("doc_id", "text").limit(60).collect()]
    for given in (rows, odd_rows):
        found = bloom_lm.score(documents(given).repartition(3)).collect()
        check_base(found, given)
        got = sorted((str(g.doc_id), g.score) for g in found)
        want = whole_scores(given)
        assert [g[0] for g in got] == [w[0] for w in want]
        assert np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-2)


def test_filter_reads_back_the_steps_of_its_counts():
    keys = bloom_lm.mix(np.arange(1, 5001, dtype=np.uint64))
    counts = np.random.default_rng(0).integers(1, 10000, 5000)
    bloom = bloom_lm.Filter(keys, counts)
    read = bloom.read(keys)
    assert (read >= bloom_lm.value_of(bloom_lm.steps_of(counts))).all()
    assert (read <= counts).mean() > 0.97 and (read * 1.2 >= counts).all()
    assert (bloom.read(bloom_lm.mix(np.arange(10**6, 10**6 + 20000, dtype=np.uint64))) > 0).mean() < 0.02
    assert (bloom_lm.Filter(keys[:0], counts[:0]).read(keys) == 0).all()


def test_bigrams_travel_as_bytes():
    r = np.random.default_rng(5)
    for width in (bloom_lm.KNOWN, bloom_lm.RARE):
        for n in (0, 1, 300):
            key, other = r.integers(0, 1 << 63, n, dtype=np.uint64), r.integers(0, 1 << (8 * width - 1), n, dtype=np.uint64)
            rows, times, train = r.integers(0, 1 << 20, n), r.integers(1, 1 << 20, n), r.integers(0, 2, n).astype(bool)
            back = bloom_lm.unpacked(bloom_lm.packed(key, other, width, rows, times, train), n, width)
            for have, sent in zip(back, (key & np.uint64((1 << 48) - 1), other, rows, times, train)):
                assert (have == sent).all()


def test_quality_of_held_out_documents(small):
    got = {r.doc_id: r for r in pairwise_quality.score(*small).collect()}
    assert len(got) == small[0].count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    apart = [(got[r.doc_id], r.quality) for r in small[1].collect() if got[r.doc_id].held_out]
    assert np.mean([g.predicted == q for g, q in apart]) >= 0.9


def test_quality_learns_nothing_from_held_out_labels(small, spark):
    docs, labels = small
    wrong = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    one, two = ({r.doc_id: r.score for r in pairwise_quality.score(docs, x).collect()} for x in (labels, wrong))
    assert np.allclose([one[i] for i in sorted(one)], [two[i] for i in sorted(one)])


def test_quality_scores_are_one_weighted_sum_of_the_measures(small):
    docs, labels = small
    got = {r.doc_id: r for r in queries.QUERIES["op4_pairwise_quality"](docs.sparkSession, SMALL).collect()}
    rows = pairwise_quality.measure(docs).collect()
    x = np.array([[*r.measures, 1.0] for r in rows])
    p = np.array([got[r.doc_id].score for r in rows])
    assert len(rows) == len(got) > 2 * x.shape[1]
    inner = (p > 1e-9) & (p < 1 - 1e-9)  # beyond, too few digits are left
    z = np.log(p[inner] / (1 - p[inner]))
    weights = np.linalg.lstsq(x[inner], z, rcond=None)[0]
    assert np.allclose(x[inner] @ weights, z, atol=1e-4)
    # The weights rank good above bad: most pairs of learned documents come in the right order.
    mark = {r.doc_id: r.quality for r in labels.collect()}
    good, bad = ([got[i].score for i, q in mark.items() if q == k and i in got] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) >= 0.95


def test_quality_of_odd_rows(documents, odd_rows, spark):
    docs = documents(odd_rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in pairwise_quality.score(docs, none).collect()} == {0.7}
    some = spark.createDataFrame([(i, i % 2) for i in range(1, 15)] + [(1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    assert pairwise_quality.score(docs, some).filter("score BETWEEN 0 AND 1").count() == len(odd_rows)
    assert pairwise_quality.score(documents([]), some).count() == 0


def test_toxicity_of_the_small_table(small):
    got = {r.doc_id: r for r in toxicity.classify(*small).collect()}
    marks = {r.doc_id: r.toxic for r in small[1].collect()}
    assert len(got) == small[0].count()
    assert np.mean([got[i].toxic == (m == 1) for i, m in marks.items()]) >= 0.95
    assert sum(got[i].toxic for i, m in marks.items() if m == 0) <= 0.01 * len(marks)


def test_later_categories_see_earlier_ones(documents, spark):
    rows, marks = [], []
    for i in range(400):
        a, b = i % 2, i % 4 == 3
        rows.append((i, f"plain words {'awful' if a else 'fine'} number {i} {'terrible' if b and i % 8 == 3 else ''}"))
        marks.append((i, a, int(b)))
    chain = toxicity.train(documents(rows), spark.createDataFrame(marks, "doc_id long, rude int, threat int"), ["rude", "threat"])
    assert chain.categories == ["rude", "threat"] and len(chain.weights[1]) == len(chain.chosen) + 1
    assert chain.weights[1][-1] > 0  # a rude document is likelier to threaten


def feature_key(piece):
    """The key of one letter run, or of a longer run's beginning."""
    data = piece.encode()
    block = Block(np.frombuffer(data, np.uint8), np.array([0, len(data)]), 0)
    return toxicity.keys_of(block)[0].tolist()


def plain_probabilities(chain, text):
    """The chain's probabilities of one text, term by term."""
    keys = Counter(k for run in re.findall(rb"[A-Za-z\x80-\xff]+", (text or "").encode()) for k in feature_key(run.decode("utf-8", "replace")))
    x = [math.log1p(keys[int(k)]) for k in chain.chosen]
    seen = []
    for w, b in zip(chain.weights, chain.intercepts):
        z = b + sum(a * c for a, c in zip(w, [*x, *seen]))
        seen.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
    return seen


def test_toxicity_scores_term_by_term(small):
    docs, labels = small
    chain = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in queries.QUERIES["op1_toxicity_chain"](docs.sparkSession, SMALL).collect()}
    for r in docs.select("doc_id", "text").limit(40).collect():
        if (r.text or "").isascii():
            severe, toxic = plain_probabilities(chain, r.text)
            assert np.allclose([got[r.doc_id].p_severe, got[r.doc_id].p_toxic], [severe, toxic], atol=1e-9)
            assert got[r.doc_id].toxic == (max(severe, toxic) >= toxicity.THRESHOLD)


def test_fold_models_see_nothing_of_their_fold(small):
    docs, labels = small
    fold = "pmod(xxhash64(CAST(doc_id AS LONG), 5), 3)"
    wrong = labels.selectExpr("doc_id", f"CASE WHEN {fold} = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    one, two = toxicity.train(docs, labels), toxicity.train(docs, wrong)
    assert (one.folds[1][0] == two.folds[1][0]).all() and np.allclose(one.folds[1][1][0], two.folds[1][1][0])
    assert len(one.folds[0][0]) != len(two.folds[0][0]) or (one.folds[0][0] != two.folds[0][0]).any()


def test_newton_steps_reach_the_least_penalised_loss(spark):
    r = np.random.default_rng(3)
    n, d = 300, 4
    x = np.log1p(r.poisson(1.0, (n, d)))
    y = (r.random(n) < 1 / (1 + np.exp(-(x @ [2.0, -1.5, 0.5, 0.0] - 0.5)))).astype(int)
    fold = r.integers(0, toxicity.FOLDS, n)
    rows = spark.createDataFrame(
        [(int(fold[i]), [j for j in range(d) if x[i, j]], [float(v) for v in x[i] if v], int(y[i])) for i in range(n)],
        "fold long, at array<int>, x array<double>, c0 long")
    places = [np.arange(d)] * (toxicity.FOLDS + 1)
    found = toxicity.fit(rows, ["c0"] * (toxicity.FOLDS + 1), d, places, [], list(range(toxicity.FOLDS + 1)))
    for m, w in found.items():
        own = fold != m
        a = np.concatenate([np.ones((own.sum(), 1)), x[own]], 1)
        weight = np.concatenate([[0], toxicity.PENALTY * x[own].var(0)])
        slope = a.T @ (1 / (1 + np.exp(-a @ w)) - y[own]) / own.sum() + weight * w
        assert np.abs(slope).max() < 1e-4


def test_toxicity_of_odd_rows(documents, odd_rows, spark):
    docs = documents(odd_rows)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.classify(docs, none).filter("kept").count() == len(odd_rows)
    same = spark.createDataFrame([(1, 0), (2, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.classify(docs, same).filter("kept").count() == len(odd_rows)
    stay = toxicity.drop_toxic(docs, same)
    assert stay.count() == len(odd_rows) and stay.columns == docs.columns
    assert toxicity.classify(documents([]), same).count() == 0


def base_rules(text):
    w = words(text)
    windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    twice = {j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(twice),
            len(w) < 10 or 100 * len(twice) > 20 * len(w))


def test_base_rules(small, documents, odd_rows):
    for docs, rows in ((small[0], [(r.doc_id, r.text) for r in small[0].collect()]), (documents(odd_rows), odd_rows)):
        got = line_rules.judge(docs).collect()
        columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert sorted((str(g.doc_id), *(g[c] for c in columns)) for g in got) == sorted((str(i), *base_rules(t)) for i, t in rows)
        assert not any(g.kept and g.base_failed for g in got)
    assert line_rules.judge(documents([])).count() == 0


def test_lines_that_fail_are_removed(documents):
    good, more = "This is a line of plain words that ends as it should.", "Another sentence of different words stands here, and it is complete."
    bad = ("WHY!! ARE!! YOU!! SHOUTING!! ALL!! THESE!! WORDS!! AT!! ME!!", "home | news | sport | about | contact",
           "a### b$$$ c%%% d&&& e### f$$$", "We use cookies to make this page better for you.",
           "this line has many words but it never comes to any sort of end")
    rows = [(1, "\n".join([good, *bad, more])), (2, "\n".join([good, more, "", bad[0]])), (3, "\n".join(bad))]
    got = {r.doc_id: r for r in line_rules.judge(documents(rows)).collect()}
    assert got[1].cleaned_text == good + "\n" + more and not got[1].kept
    assert got[2].cleaned_text == "\n".join([good, more, ""]) and got[2].kept
    assert got[3].cleaned_text == "" and not got[3].kept


def test_lines_may_end_in_the_marks_of_any_script(documents):
    whole = ("これ は ペン です 。 それ は 本 です。", "यह एक अच्छा वाक्य है जो यहाँ पूरा होता है।", "هل هذه جملة كاملة من عشر كلمات أو أكثر هنا؟",
             "one two three four five six seven eight nine ten…", "„one two three four five six seven eight nine.”", "one two three four five six seven eight (nine.)")
    open_ended = ("これ は ペン です それ は 本 です よ", "यह एक अच्छा वाक्य है जो यहाँ पूरा नहीं", "one two three four five six seven eight nine”",
                  "一 二 三 四 五 六 七 八！ 九！ 十！ 百！")
    got = {r.doc_id: r.cleaned_text for r in line_rules.judge(documents([(1, "\n".join(whole)), (2, "\n".join(open_ended))])).collect()}
    assert got[1] == "\n".join(whole) and got[2] == ""


def test_labels_agree_with_the_rules(small):
    kept = {r.doc_id: r.kept for r in line_rules.judge(small[0]).collect()}
    marks = {r.doc_id: r.quality for r in small[1].collect()}
    assert np.mean([kept[i] == (q == 1) for i, q in marks.items()]) >= 0.9


def test_every_quality_label_outside_the_held_out_part_is_learned_from(small, monkeypatch):
    """No bound on the training documents: the pairs are made from all of them."""
    docs, labels = small
    seen = []
    whole = pairwise_quality.preference_pairs
    monkeypatch.setattr(pairwise_quality, "TRAINING_ROWS", 20, raising=False)
    monkeypatch.setattr(pairwise_quality, "preference_pairs", lambda rows: seen.append(rows.count()) or whole(rows))
    pairwise_quality.score(docs, labels).count()
    marked = labels.filter("quality is not null and crc32(cast(doc_id as string)) % 4 <> 2").select("doc_id").distinct()
    assert seen == [docs.join(marked, "doc_id").count()] and seen[0] > 20
