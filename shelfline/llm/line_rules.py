"""Quality rules, line first: lines that fail a rule are removed, then documents that lose too much text are rejected.

A line with a word fails if it
* shouts: more than 30 % of its words end in an exclamation mark;
* is made of symbols: characters of `#*$%&|<>` are more than 10 % of its words' bytes;
* navigates: it has three or more separators standing alone (`|`, `>`, `<`, `»`, `•`, `·`), at least one per eight words;
* is boilerplate: it contains one of PHRASES;
* has no punctuation: eight or more words and no word that ends in a terminal mark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.measures import between, flags, per_text, repeated_lines, repeated_words
from shelfline.llm.text import Block, blocks, column, prepare, span_hash

SYMBOLS = b"#*$%&|<>"
PHRASES = (
    "all rights reserved", "cookie policy", "we use cookies", "privacy policy", "terms of use", "terms of service",
    "enable javascript", "click here to", "sign up for our newsletter", "subscribe to our", "skip to content", "lorem ipsum",
    "licensed under", "powered by wordpress")
# Marks that end a sentence in the scripts that have them, and marks that may follow one.
_TERMINAL = (".", "!", "?", "…", "。", "！", "？", "．", "।", "॥", "؟", "۔", "։", "።", "፧", "។", "။", "᠃")
_SHOUTING = ("!", "！")
_CLOSING = ('"', "'", ")", "]", "”", "’", "»", "」", "』", "）")
_SEPARATORS = [s.encode() for s in ("|", ">", "<", "»", "•", "·")]


def phrase_lines(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Which lines contain a phrase."""
    found = []
    for phrase in PHRASES:
        sought, at = phrase.encode(), -1
        while (at := data.find(sought, at + 1)) >= 0:
            found.append(at)
    hit = np.zeros(len(starts), bool)
    if found:
        hit[np.searchsorted(starts, np.array(found), side="right") - 1] = True
    return hit


def ending(data: np.ndarray, begin: np.ndarray, end: np.ndarray, marks: Sequence[str]) -> np.ndarray:
    """How many bytes of each span are the mark that it ends in; 0 if it ends in none of them."""
    out = np.zeros(len(end), np.int64)
    codes = [mark.encode() for mark in marks]
    final = np.zeros(256, bool)
    final[[code[-1] for code in codes]] = True
    likely = np.flatnonzero(final[data[end - 1]])
    for mark in codes:
        same = likely[(end - begin)[likely] >= len(mark)]
        for back, byte in enumerate(reversed(mark), 1):
            same = same[data[end[same] - back] == byte]
        out[same] = len(mark)
    return out


def failing_lines(block: Block, starts: np.ndarray, ends: np.ndarray, words: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Words per line, and which lines fail a rule."""
    begin, end, _ = words
    place = np.searchsorted(begin, np.stack([starts, ends]))
    count = place[1] - place[0]
    inside = lambda x: np.concatenate([[0], np.cumsum(x)])[place]
    held = lambda x: np.subtract(*inside(x)[::-1])
    closed = ending(block.data, begin, end, _CLOSING)
    last = end - np.where(closed < end - begin, closed, 0)
    alone = np.zeros(len(begin), bool)
    for mark in _SEPARATORS:
        same = np.flatnonzero(end - begin == len(mark))
        for i, byte in enumerate(mark):
            same = same[block.data[begin[same] + i] == byte]
        alone[same] = True
    separators, symbols = held(alone), between(flags(block, SYMBOLS), starts, ends)
    lowered = block.data.tobytes().lower()
    bad = (
        (10 * held(ending(block.data, begin, last, _SHOUTING) > 0) > 3 * count)
        | (10 * symbols > held(end - begin))
        | ((separators >= 3) & (8 * separators >= count))
        | phrase_lines(lowered, starts)
        | ((count >= 8) & (held(ending(block.data, begin, last, _TERMINAL) > 0) == 0)))
    return count, bad & (count > 0)


def judge(docs: DataFrame, most_lost: int = 50) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    kept_words, cleaned_text.

    `cleaned_text` is the text without the lines that fail, each line otherwise as it was. A document is kept if it passes the
    base rules (ten words or more, at most 20 % of them in repeated windows) and loses at most `most_lost` per cent of its words.
    A null or empty text has no words: it fails the base rules. Other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                words = block.words()
                begin, end, first = words
                starts, ends, lines = block.lines()
                count, bad = failing_lines(block, starts, ends, words)
                n = np.diff(first)
                repeated = repeated_words(span_hash(block.prefix(), begin, end), first)
                kept_words = per_text(np.where(bad, 0, count), lines)
                failed = (n < 10) | (100 * repeated > 20 * n)
                characters = (block.data & 0xC0) != 0x80
                data, good = block.data.tobytes(), ~bad
                texts = [
                    b"\n".join(data[a:z] for a, z in zip(starts[low:high][good[low:high]].tolist(), ends[low:high][good[low:high]].tolist()))
                    for low, high in zip(lines[:-1].tolist(), lines[1:].tolist())]
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(block.first, block.n),
                    "n_words": column(n.astype(np.int64)),
                    "word_chars": column(per_text(between(characters, begin, end), first).astype(np.int64)),
                    "n_symbols": column(block.counts(flags(block, SYMBOLS)).astype(np.int64)),
                    "n_dup_lines": column(repeated_lines(block, starts, ends, lines, count > 0).astype(np.int64)),
                    "n_repeat_words": column(repeated.astype(np.int64)),
                    "base_failed": column(failed),
                    "kept": column(~failed & (100 * (n - kept_words) <= most_lost * n)),
                    "kept_words": column(kept_words.astype(np.int64)),
                    "cleaned_text": pa.array(texts, pa.binary()).cast(pa.string())})

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, kept boolean, kept_words long, cleaned_text string")
