"""Language identification by word-first backoff.

A known word is scored by its log frequency in each language; an unseen one by
its longest character n-grams that are known, trying shorter ones until some
are. The model is fitted on a sample of labelled texts, bounded by
``sample_docs`` texts a language, and holds every word and n-gram of that sample, so the
broadcast grows with languages times the words of ``sample_docs`` texts; frequencies are kept
only where they are not 0. A smaller model is to be had by ``max_words`` and ``max_grams``, the
numbers of commonest words and n-grams that each language keeps. Texts are drawn by a hash of id
and text, so many texts of one id, or of none, are drawn apart.

Besides the language, a text gets the probability that the words give it, and how
well it fits: the share of its words that the model knows, with 1 over the root of their
number added, 1 at most, as a short text may miss by chance. The probability of a long text is near 1
even if it is in none of the languages; its fit is not.

Null and empty texts and texts without a letter get ``und``, score 0 and fit 0. Words
are runs of ASCII letters and characters outside ASCII, A-Z lower-cased. Ties
go to the first language in code point order. With no training text every
document is ``und``. Very long texts are read whole, a text at a time. Other columns are
ignored and kept; repeated rows are scored alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .kit import ALPHA, Spans, batch_of, lookup, more, per_row, ranges, row_of, slices, text_bytes, word_spans

SAMPLE_DOCS = 3000
LONGEST = 4
UNKNOWN = "und"


@dataclass(frozen=True)
class Level:
    """Log frequencies of words, or of n-grams of one length: of what a language never has (base), and what others add to it.

    keys: sorted hashes; key k has the entries first[k] to first[k + 1] of lang and gain.
    """

    keys: np.ndarray
    first: np.ndarray
    lang: np.ndarray
    gain: np.ndarray
    base: np.ndarray


@dataclass(frozen=True)
class Model:
    """Languages; a level for words, then one for each length of n-grams."""

    languages: list[str]
    levels: list[Level]


def _gram_spans(data, start, end, n):
    """Byte spans of the n-grams of characters in each word, and each n-gram's word."""
    chars = np.flatnonzero(np.append((data & 0xC0) != 0x80, True))
    first, last = np.searchsorted(chars, start), np.searchsorted(chars, end)
    count = np.maximum(last - first - n + 1, 0)
    at = np.repeat(first, count) + ranges(count)
    return chars[at], chars[at + n], np.repeat(np.arange(len(start)), count)


def _counts(batches):
    """Counts of words (n = 0) and n-grams by language."""
    schema = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("h", pa.int64()), ("c", pa.int64())])
    for batch in slices(batches):
        data, offsets = text_bytes(batch.column("text"))
        start, end, first = word_spans(data, offsets, ALPHA)
        spans = Spans(data)
        lang = batch.column("lang").dictionary_encode()
        codes = lang.indices.to_numpy(zero_copy_only=False)[row_of(first)]
        names = lang.dictionary
        hashes = spans.hashes(start, end)
        for n in range(LONGEST + 1):
            if n:
                a, b, word = _gram_spans(data, start, end, n)
                h, code = spans.hashes(a, b), codes[word]
            else:
                h, code = hashes, codes
            for k in range(len(names)):
                keys, counts = np.unique(h[code == k], return_counts=True)
                yield batch_of(schema, pa.array([names[k].as_py()] * len(keys), pa.string()), np.full(len(keys), n, np.int32), keys.view(np.int64), counts)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS, max_words: int | None = None, max_grams: int | None = None) -> Model:
    """Fit on about sample_docs labelled texts of each language, chosen by a hash of id and text."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("docs"))
    share = F.lit(float(sample_docs)) / F.col("docs")
    drawn = rows.join(F.broadcast(sizes), "lang").where(F.pmod(F.xxhash64("id", "text", F.lit("langid")), F.lit(1 << 20)) < share * (1 << 20))
    counted = drawn.select("text", "lang").mapInArrow(_counts, "lang string, n int, h long, c long").groupBy("lang", "n", "h").agg(F.sum("c").alias("c"))
    for most, level in ((max_words, F.col("n") == 0), (max_grams, F.col("n") > 0)):
        if most is not None:
            nth = F.row_number().over(W.partitionBy("lang", level).orderBy(F.desc("c"), "n", "h"))
            counted = counted.withColumn("nth", nth).where(~level | (F.col("nth") <= most)).drop("nth")
    table = counted.toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    code = np.searchsorted(np.array(languages, dtype=object), np.array(table["lang"].to_pylist(), dtype=object)) if languages else np.zeros(0, np.int64)
    n, h, c = (table[x].to_numpy() for x in ("n", "h", "c"))
    return Model(languages, [_level(h[n == k].view(np.uint64), code[n == k], c[n == k], len(languages)) for k in range(LONGEST + 1)])


def _level(h, code, c, n_languages) -> Level:
    keys, at = np.unique(h, return_inverse=True)
    by = np.argsort(at, kind="stable")
    total = np.bincount(code, weights=c, minlength=n_languages) + 0.5 * len(keys) + 1.0
    first = np.searchsorted(at[by], np.arange(len(keys) + 1))
    return Level(keys, first, code[by].astype(np.int32), np.log((c[by] + 0.5) / 0.5), np.log(0.5 / total))


def _add(out: np.ndarray, level: Level, row: np.ndarray, key: np.ndarray, weight: np.ndarray) -> None:
    """Add to the rows of out the log frequencies of keys (places in the level), times weight."""
    count = level.first[key + 1] - level.first[key]
    at = np.repeat(level.first[key], count) + ranges(count)
    width = out.shape[1]
    gains = np.repeat(weight, count) * level.gain[at]
    out += np.bincount(np.repeat(row, count) * width + level.lang[at], weights=gains, minlength=out.size).reshape(out.shape)
    out += np.bincount(row, weights=weight, minlength=len(out))[:, None] * level.base[None, :]


def score_batch(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, its probability and the fit of each text of a column."""
    data, offsets = text_bytes(column)
    start, end, first = word_spans(data, offsets, ALPHA)
    none = np.zeros(len(column))
    if not model.languages:
        return [UNKNOWN] * len(column), none, none
    spans, row = Spans(data), row_of(first)
    hashes = spans.hashes(start, end)
    at = lookup(model.levels[0].keys, hashes)
    known = at >= 0
    total = np.zeros((len(column), len(model.languages)))
    _add(total, model.levels[0], row[known], at[known], np.ones(int(known.sum())))
    # unseen words: each distinct one once, with its average over the longest n-grams that are known
    _, where, same = np.unique(hashes[~known], return_index=True, return_inverse=True)
    a, b = start[~known][where], end[~known][where]
    logs, left = np.zeros((len(a), len(model.languages))), np.arange(len(a))
    for n in range(LONGEST, 0, -1):
        if not len(left):
            break
        x, y, word = _gram_spans(data, a[left], b[left], n)
        gram = lookup(model.levels[n].keys, spans.hashes(x, y))
        word, gram = word[gram >= 0], gram[gram >= 0]
        found = np.bincount(word, minlength=len(left))
        some = np.zeros((len(left), len(model.languages)))
        _add(some, model.levels[n], word, gram, 1 / found[word])
        logs[left] = some
        left = left[found == 0]
    for k in range(len(model.languages)):
        total[:, k] += np.bincount(row[~known], weights=logs[same, k], minlength=len(column))
    best = total.argmax(axis=1)
    probability = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    n_words = np.maximum(np.diff(first), 1)
    fit = np.minimum(1, per_row(known.astype(float), first) / n_words + 1 / np.sqrt(n_words))
    ascii_letter = np.zeros(256, dtype=bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    lettered = per_row(ascii_letter[data], offsets) > 0
    for i in np.flatnonzero(~lettered):
        lettered[i] = any(map(str.isalpha, column[int(i)].as_py() or ""))
    return [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)], np.where(lettered, probability, 0.0), np.where(lettered, fit, 0.0)


def identify(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "fit")) -> DataFrame:
    """All columns of docs, with the language, its probability and its fit added (or replaced) under the given names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*(c for c in docs.columns if c not in names))
    old = kept.columns

    def run(batches):
        for batch in slices(batches, text_col):
            lang, score, fits = score_batch(shared.value, batch.column(text_col))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(fits, pa.float64())], names=[*old, *names])

    return kept.mapInArrow(run, more(kept, f"`{names[0]}` string, `{names[1]}` double, `{names[2]}` double"))
