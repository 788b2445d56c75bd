from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves; a table may have them too.
CLASHING = ("digest", "keep_id", "size", "node", "root", "bands", "shard", "cell", "score", "kept", "held_out", "ids", "text_key", "__id")


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table with clashing extra columns from (doc_id, text, source) or (doc_id, text)."""

    def build(rows, extra=True):
        rows = [(*r, "s")[:3] for r in rows]
        df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)
        if extra:
            df = df.selectExpr("*", *(f"'x' AS `{c}`" for c in CLASHING))
        return df

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, and text that is not ASCII."""
    long = " ".join(f"w{i}" for i in range(30000))
    return [
        (1, "one two three four five six seven"), (2, "one  two\tthree four five six\nseven"), (3, None), (4, ""), (5, "   "),
        (6, "ONE TWO three four five six seven"), (7, "kurz"), (8, "Kurz"), (9, long), (10, long + " end"), (11, "ä ö ü é 中文 😀 x"),
        (1, "one two three four five six seven"), (None, "no id here at all"), (None, "no id here at all"), (12, None), (13, " lead and trail "),
        (14, "it's we'll they'd  tab\t\tend \n\n new"), (7, "another text with the same id"),
    ]


@pytest.fixture(scope="session")
def families():
    """Groups of near copies, chains, and many texts around one passage that aren't copies of each other."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows, n = [], 0
    for size in (2, 3, 8, 40):
        base = [word() for _ in range(120)]
        for _ in range(size):
            copy = list(base)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = word()
            rows.append((n := n + 1, " ".join(copy)))
    chain = [word() for _ in range(200)]
    for step in range(12):  # each is near the next, the ends aren't near each other
        rows.append((n := n + 1, " ".join(chain[step * 10 : step * 10 + 100])))
    passage = [word() for _ in range(60)]
    for _ in range(60):
        rows.append((n := n + 1, " ".join(passage + [word() for _ in range(r.randint(10, 60))])))
    r.shuffle(rows)
    return rows
