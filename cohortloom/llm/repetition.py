"""Quality rules on repeated words, from a suffix array of each text's words.

The words of a slice of texts are sorted as suffixes by prefix doubling; a
suffix never runs into the next text. Longest common prefixes of neighbours in
that order give, for each word, the longest string from there on that occurs
elsewhere in its text. The strings of at least ``min_words`` words are the
occurrences of the maximal repeated substrings (the intervals of common
prefixes); the union of their spans is the covered part. A text fails if that
is more than ``max_covered`` per cent of its words, or its longest repeat has more than
``max_longest`` words or more than ``max_longest_share`` per cent of the text's.

Limits: published web filters cut at 15 to 20 per cent for words in repeated strings of
this length. In prose of the given tables the covered share is 0 at the median, 3 per cent at
the 95th percentile and 10 at the 99th, and repeats have 2, 6 and 9 words.

Null and empty texts have no words, cover nothing and pass these limits. Very long
texts are sorted whole, a text at a time. Each row is judged alone, so copies and ties
need no rule; columns with the names added here are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import NOT_SPACE, Spans, line_spans, more, per_row, row_of, slices, text_bytes, windows, word_spans

MIN_WORDS = 4
MAX_COVERED = 20
MAX_LONGEST = 30
MAX_LONGEST_SHARE = 15
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_covered long, longest_repeat long"


def suffix_order(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of each row's keys in sorted order, and the common prefix of each with the one before it.

    keys: any integers; rows are apart, a shorter suffix comes first.
    """
    n = len(keys)
    row = row_of(first)
    end = first[row + 1]
    order = np.lexsort((keys, row))
    differs = np.ones(n, dtype=bool)
    differs[1:] = (keys[order][1:] != keys[order][:-1]) | (row[order][1:] != row[order][:-1])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(differs, np.arange(n), 0))
    levels, step = [rank.copy()], 1
    while not differs.all():
        tied = ~differs
        tied[:-1] |= ~differs[1:]
        at = np.flatnonzero(tied)
        suffix = order[at]
        after = suffix + step
        second = np.where(after < end[suffix], rank[np.minimum(after, n - 1)], -1)
        again = np.lexsort((second, rank[suffix]))
        suffix, second = suffix[again], second[again]
        order[at] = suffix
        differs[at[1:]] = differs[at[1:]] | (second[1:] != second[:-1])
        rank[suffix] = np.maximum.accumulate(np.where(differs, np.arange(n), 0))[at]
        levels.append(rank.copy())
        step *= 2
    common = np.zeros(n, dtype=np.int64)
    live = np.arange(1, n)
    a, b = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        ok = (a < end[order[live - 1]]) & (b < end[order[live]])
        same = np.zeros(len(live), dtype=bool)
        same[ok] = levels[k][a[ok]] == levels[k][b[ok]]
        common[live[same]] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return order, common


def covered(first: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether each word lies in one of the spans."""
    edge = np.zeros(first[-1] + 1, dtype=np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge)[:-1] > 0


def repeats(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest string from it on that occurs again in its row."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    _, keys = np.unique(hashes, return_inverse=True)
    order, common = suffix_order(keys, first)
    out = np.empty(len(hashes), dtype=np.int64)
    out[order] = np.maximum(common, np.append(common[1:], 0))
    return out


def measure(column: pa.Array, min_words: int) -> list[np.ndarray]:
    """The columns of FIELDS."""
    data, offsets = text_bytes(column)
    start, end, first = word_spans(data, offsets, NOT_SPACE)
    spans = Spans(data, lower=False)
    hashes = spans.hashes(start, end)
    row = row_of(first)
    n_words = np.diff(first)
    leads = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    chars = per_row(leads[end] - leads[start], first)
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS.encode())] = True
    symbols = per_row(symbol[data], offsets)

    a, b, line_first = line_spans(data, offsets)
    worded = np.searchsorted(start, b) > np.searchsorted(start, a)
    line, of = spans.hashes(a, b)[worded], row_of(line_first)[worded]
    by = np.lexsort((line, of))
    again = (line[by][1:] == line[by][:-1]) & (of[by][1:] == of[by][:-1])
    dup_lines = np.bincount(of[by][1:][again], minlength=len(n_words))

    three, at = windows(hashes, first, 3)
    by = np.lexsort((three, row[at]))
    same = (three[by][1:] == three[by][:-1]) & (row[at[by]][1:] == row[at[by]][:-1])
    twice = np.zeros(len(at), dtype=bool)
    twice[by[1:][same]] = twice[by[:-1][same]] = True
    repeat_words = per_row(covered(first, at[twice], np.full(twice.sum(), 3)), first)

    longest = repeats(hashes, first)
    long = np.flatnonzero(longest >= min_words)
    n_covered = per_row(covered(first, long, longest[long]), first)
    most = np.zeros(len(n_words), dtype=np.int64)
    np.maximum.at(most, row, longest)
    return [n_words, chars, symbols, dup_lines, repeat_words, n_covered, most]


def rules(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS, max_covered: int = MAX_COVERED, max_longest: int = MAX_LONGEST, max_longest_share: int = MAX_LONGEST_SHARE) -> DataFrame:
    """All columns of docs but those of FIELDS, with FIELDS and ``repetitive`` added."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    kept = docs.select(*(c for c in docs.columns if c not in (*names, "repetitive")))
    old = kept.columns

    def run(batches):
        for batch in slices(batches, text_col):
            found = measure(batch.column(text_col), min_words)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x.astype(np.int64)) for x in found)], names=[*old, *names])

    out = kept.mapInArrow(run, more(kept, FIELDS))
    n = F.col("n_words")
    return out.withColumn("repetitive", (100 * F.col("n_covered") > max_covered * n) | (F.col("longest_repeat") > max_longest) | (100 * F.col("longest_repeat") > max_longest_share * n))
