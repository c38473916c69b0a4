"""License scans: a generalised suffix automaton of template words, streamed over texts.

The automaton holds the words of all templates: whole licenses and the notices that
stand for them, several of each family. Streaming a text through it gives
the matching statistics: at each word, the length of the longest string ending
there that some template holds. Matches of at least ``min_match`` words that neither side
extends, with every place that they have in a template, are chained, in order in both text and template,
into a covered span of each template. A template labels the text if ``min_cover`` of its
words are covered, and ``MIN_WORDS`` of them or all of a shorter one, unless another
template covers more words, or as many and more of its own, on the same span or a wider
one (a notice of one variant is nearly that of the next).

Words are runs of ASCII letters, digits and characters outside ASCII, A-Z
lower-cased. Null and empty texts have no words, no labels and score 0. Very long texts
take time in proportion to their words, and to matches times their logarithm. Ties
between templates keep all labels. Each row is judged alone, so repeated rows are
judged alike; columns with the names of FIELDS are replaced.
"""

from __future__ import annotations

import heapq
import importlib.resources
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kit import ALNUM, Spans, hash_words, lookup, more, row_of, slices, text_bytes, windows, word_spans

#: Phrases and the labels they stand for.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


def templates() -> list[tuple[str, str]]:
    """Fixed values, in license_texts: label and words of public licenses and notices, from files named label__name.txt."""
    files = importlib.resources.files("cohortloom.llm") / "license_texts"
    return [(f.name.split("__")[0], f.read_text(encoding="utf-8")) for f in sorted(files.iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")]


MIN_WORDS = 8

_WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text: str) -> list[str]:
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


class Automaton:
    """Generalised suffix automaton over word numbers; each state knows all ends of its strings in each template."""

    def __init__(self, sequences: list[list[int]]):
        self.sequences = sequences
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list] = [[]]
        for t, sequence in enumerate(sequences):
            last = 0
            for i, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].append((t, i + 1))
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.link[state]:
                self.ends[self.link[state]] += self.ends[state]

    def _add(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.length) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._add(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if (q := self.next[last].get(word)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new, p = self._add(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def matches(self, stream: list[int], min_match: int) -> list[tuple[int, int, int, int]]:
        """(template, start in stream, start in template, length) of matches that can be extended on neither side.

        The state gives the longest match; on the way up its links are the places of the
        templates that hold only a shorter one.
        """
        out, state, length = [], 0, 0
        for i, word in enumerate([*stream, -1]):
            s, n, seen = state, length, set()
            while n >= min_match:
                for t, end in self.ends[s]:
                    if (t, end) not in seen:
                        seen.add((t, end))
                        if end == len(self.sequences[t]) or self.sequences[t][end] != word:
                            out.append((t, i - n, end - n, n))
                s = self.link[s]
                n = self.length[s]
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                length = 0
        return out


def chain(matches: list[tuple[int, int, int]], size: int) -> tuple[int, int, int]:
    """The chain of matches (start in text, start in template, length) that covers most: words, first, last word's end.

    Matches come by their start in the text; those that ended before it wait in a tree
    of the best chain up to each place of the template (size words). Ties: the shortest span, then the earliest.
    """
    tree = [(0, 0)] * (size + 1)
    waiting: list = []
    best = (0, 0, 0)
    for a, b, n in sorted(matches):
        while waiting and waiting[0][0] <= a:
            _, at, value = heapq.heappop(waiting)
            while at <= size:
                tree[at] = max(tree[at], value)
                at += at & -at
        top, at = (0, 0), b
        while at:
            top = max(top, tree[at])
            at -= at & -at
        value = (top[0] + n, top[1] if top[0] else a)
        heapq.heappush(waiting, (a + n, b + n, value))
        best = max(best, (value[0], value[1] - (a + n), -value[1]))
    return best[0], -best[2], -best[2] - best[1]


def outdone(found: list[tuple[tuple[int, float], int, int]]) -> list[bool]:
    """Whether each ((words covered, share of the template), first, end) lies in the span of a greater one."""
    ends = sorted({-end for _, _, end in found})
    place = {end: k + 1 for k, end in enumerate(ends)}
    tree, out = [(0, 0.0)] * (len(ends) + 1), [False] * len(found)
    order = sorted(range(len(found)), key=lambda k: found[k][1])
    k = 0
    while k < len(order):
        stop = k
        while stop < len(order) and found[order[stop]][1] == found[order[k]][1]:
            stop += 1
        same = order[k:stop]
        for j in same:
            at = place[-found[j][2]]
            while at <= len(ends):
                tree[at] = max(tree[at], found[j][0])
                at += at & -at
        for j in same:
            at = place[-found[j][2]]
            while at:
                out[j] = out[j] or tree[at] > found[j][0]
                at -= at & -at
        k = stop
    return out


class Scanner:
    """What a task holds: word numbers, the automaton, and the short strings by which texts are told to be worth streaming."""

    def __init__(self, templates, min_match: int, min_cover: float):
        self.labels = [label for label, _ in templates]
        lists = [words(text) for _, text in templates]
        vocabulary = sorted({w for x in lists for w in x})
        number = {w: i for i, w in enumerate(vocabulary)}
        self.sizes = [len(x) for x in lists]
        self.min_match, self.min_cover = min_match, min_cover
        self.automaton = Automaton([[number[w] for w in x] for x in lists])
        h = hash_words(vocabulary)
        by = np.argsort(h)
        self.hashes, self.numbers = h[by], by
        seeds = [windows(hash_words(x), np.array([0, len(x)]), min_match)[0] for x in lists]
        self.seeds = np.unique(np.concatenate(seeds))
        self.phrases = [hash_words(p.split()) for p, _ in PHRASES]

    def scan(self, column: pa.Array):
        data, offsets = text_bytes(column)
        start, end, first = word_spans(data, offsets, ALNUM)
        hashes = Spans(data).hashes(start, end)
        row, n = row_of(first), len(first) - 1
        n_base, low, high = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        base: list[set] = [set() for _ in range(n)]
        for phrase, (_, label) in zip(self.phrases, PHRASES):
            at = np.flatnonzero(hashes == phrase[0])
            for k in range(1, len(phrase)):
                at = at[(at + k < len(hashes))]
                at = at[(hashes[at + k] == phrase[k]) & (row[at + k] == row[at])]
            place = at - first[row[at]]
            np.add.at(n_base, row[at], 1)
            np.minimum.at(low, row[at], place)
            np.maximum.at(high, row[at], place)
            for r in np.unique(row[at]):
                base[r].add(label)
        short, at = windows(hashes, first, self.min_match)
        hit = at[lookup(self.seeds, short) >= 0]
        more_labels: list[set] = [set() for _ in range(n)]
        score, spans = np.zeros(n), [[] for _ in range(n)]
        ends = np.searchsorted(hit, first)
        for r in np.flatnonzero(np.diff(ends)):
            for label, cover, a, b in self._stream(hashes[first[r] : first[r + 1]], hit[ends[r] : ends[r + 1]] - first[r]):
                more_labels[r].add(label)
                score[r] = max(score[r], cover)
                spans[r].append({"label": label, "cover": cover, "first": a, "end": b})
        return np.diff(first), n_base, low, high, base, more_labels, score, spans

    def _stream(self, hashes, hit):
        """Labels of one text; only words around the seeds are streamed, as nothing else can match."""
        found: dict[int, list] = {}
        groups = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
        for group in groups:
            a, b = int(group[0]), int(group[-1]) + self.min_match
            at = lookup(self.hashes, hashes[a:b])
            stream = np.where(at >= 0, self.numbers[at], -1).tolist()
            for t, i, j, length in self.automaton.matches(stream, self.min_match):
                found.setdefault(t, []).append((a + i, j, length))
        chains: list[tuple[int, int, int, int]] = []
        for t, matches in found.items():
            near: list[list] = []
            end = 0
            for m in sorted(matches):  # matches further apart than the template is long are of another copy
                if near and m[0] - end <= self.sizes[t]:
                    near[-1].append(m)
                else:
                    near.append([m])
                end = max(end, m[0] + m[2])
            chains += [(*chain(copy, self.sizes[t]), t) for copy in near]
        chains = [x for x in chains if x[0] >= max(self.min_cover * self.sizes[x[3]], min(MIN_WORDS, self.sizes[x[3]]))]
        for (size, a, b, t), less in zip(chains, outdone([((n, n / self.sizes[t]), a, b) for n, a, b, t in chains])):
            if not less:
                yield self.labels[t], size / self.sizes[t], a, b


FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, license_spans array<struct<label:string,cover:double,first:long,end:long>>"


def scan(docs: DataFrame, text_col: str = "text", known: list[tuple[str, str]] | None = None, min_match: int = 4, min_cover: float = 0.6) -> DataFrame:
    """All columns of docs but those of FIELDS, with FIELDS added; score: 1 with a phrase, else the best cover. known: templates (label, text)."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    kept = docs.select(*(c for c in docs.columns if c not in names))
    old = kept.columns
    span = pa.list_(pa.struct([("label", pa.string()), ("cover", pa.float64()), ("first", pa.int64()), ("end", pa.int64())]))

    shared = docs.sparkSession.sparkContext.broadcast(Scanner(known or templates(), min_match, min_cover))

    def run(batches):
        scanner = shared.value
        for batch in slices(batches, text_col):
            n_words, n_base, low, high, base, extra, score, spans = scanner.scan(batch.column(text_col))
            none = n_base == 0
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(n_words), pa.array(n_base), pa.array(low, mask=none), pa.array(high, mask=none),
                pa.array([sorted(x) for x in base], pa.list_(pa.string())), pa.array([sorted(x | y) for x, y in zip(base, extra)], pa.list_(pa.string())),
                pa.array(np.where(none, score, 1.0)), pa.array(spans, span),
            ], names=[*old, *names])

    return kept.mapInArrow(run, more(kept, FIELDS))
