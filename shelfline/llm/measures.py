"""Measures of whole texts that quality operators share, for all texts of a block at once."""

from __future__ import annotations

import numpy as np

from shelfline.llm.text import Block, distinct, shingles, span_hash

WINDOW = 5


def flags(block: Block, characters: bytes) -> np.ndarray:
    chosen = np.zeros(256, bool)
    chosen[list(characters)] = True
    return chosen[block.data]


def between(flagged: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many bytes of each span are flagged."""
    total = np.concatenate([[0], np.cumsum(flagged)])
    return total[ends] - total[starts]


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums over each text's values."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def repeated_words(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text, the words that stand in a five-word window that the text has more than once."""
    counts = np.diff(first)
    windows, begin = shingles(words, first, WINDOW)
    owner = np.repeat(np.arange(len(counts)), np.diff(begin))
    order = np.lexsort((windows, owner))
    same = (windows[order][1:] == windows[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    at = at - begin[owner[at]] + first[owner[at]]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + WINDOW, -1)
    return per_text(np.cumsum(change)[:-1] > 0, first)


def repeated_lines(block: Block, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, full: np.ndarray) -> np.ndarray:
    """Per text, the lines with a word (`full`) that equal an earlier one."""
    keys = span_hash(block.prefix(), starts[full], ends[full])
    begin = np.concatenate([[0], np.cumsum(full)])[first]
    return np.diff(begin) - np.diff(distinct(keys, begin)[2])
