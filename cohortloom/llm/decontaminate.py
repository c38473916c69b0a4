"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The n-grams of the test items are counted in all documents first. An n-gram is a rare
seed if joining on it gives no more pairs than there are documents: the documents that hold it,
times its places in the items of a block. So an n-gram of one item is rare however
often that item leaked, and partial and edited copies of it are found; phrases that many
items and many documents hold are common. Of common ones, each ``STRETCH`` consecutive
n-grams of an item keep the rarest, fewer in items so short that an unbroken part worth
``min_score`` has fewer. So ``STRETCH + n - 1`` words in a row that a passage
shares with an item always hold a seed, as does any unbroken part worth ``min_score``, of n words at
least. What has neither a rare n-gram nor such a run in common with an item isn't paired with it.

Passages are joined to items on seeds. A pair goes on if the passage holds as many of the item's
words as any alignment of ``min_score`` must match, which loses nothing; then the
item is aligned with the words around each seed. The best local alignment, over that
of the item with itself, is the score, and the pair is returned if it reaches
``min_score``.

Items come to the tasks in blocks of at most ``BLOCK_ITEMS`` items and
``BLOCK_WORDS`` words, a pass over the documents for each block, so what is
broadcast has a bound whatever the benchmark's size (the counts come in another pass
of the same kind, summed in the tasks first, a number a seed); seeds are looked up for
``HITS`` pairs of words and items at a time, one passage at least. A passage that a third of
all documents hold costs each of them one alignment; nothing is grouped by it.

Words are runs of ASCII letters, digits and characters outside ASCII,
lower-cased. Null and empty texts match nothing, nor do items of fewer than n
words, which can't be told from chance. Copies of an item match alike. An
item with a null id is used like any other and gives pairs with a null item_id; ids may be
of any type. A document with a null doc_id gives pairs with a null doc_id; repeated rows
give repeated pairs. Very long texts are aligned only around their seeds. Other columns
are ignored, and kept by ``clean``. Tables without rows give no pairs.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .kit import ALNUM, Spans, batch_of, lookup, per_row, ranges, row_of, slices, text_bytes, windows, word_spans

N = 3
MIN_SCORE = 0.5
BLOCK_ITEMS = 20_000
BLOCK_WORDS = 4_000_000
#: Consecutive n-grams of an item, of which the rarest is a seed.
STRETCH = 4
#: Pairs of a passage's word and an item's that are held at once.
HITS = 500_000
MATCH, MISMATCH, GAP = 2, -1, -1


@dataclass(frozen=True)
class Block:
    """Items' ids and word hashes; sorted seed hashes with the places (item, word) that each stands for.

    words: the sorted hashes of all items' words; codes: the items' words as places there, one item after the other.
    """

    ids: list[int]
    items: list[np.ndarray]
    seeds: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    words: np.ndarray
    codes: np.ndarray
    starts: np.ndarray


def _hashes(column):
    data, offsets = text_bytes(pc.utf8_lower(column))
    start, end, first = word_spans(data, offsets, ALNUM)
    return Spans(data).hashes(start, end), first


def blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """Lists of (id, word hashes), each of bounded size; rows come to the driver a few at a time."""
    ids, items, size = [], [], 0
    rows = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).orderBy("id")
    for row in rows.toLocalIterator():
        h, _ = _hashes(pa.array([row["text"]], pa.string()))
        if ids and (len(ids) == BLOCK_ITEMS or size + len(h) > BLOCK_WORDS):
            yield ids, items
            ids, items, size = [], [], 0
        ids.append(row["id"])
        items.append(h)
        size += len(h)
    if ids:
        yield ids, items


def _places(items, n):
    """N-gram hash, item and word of every n-gram of the items."""
    first = np.append(0, np.cumsum([len(x) for x in items])).astype(np.int64)
    h, at = windows(np.concatenate([*items, np.zeros(0, np.uint64)]), first, n)
    item = row_of(first)[at] if len(at) else at
    return h, item, at - first[item]


def _block(ids, items, n) -> Block:
    h, item, place = _places(items, n)
    by = np.argsort(h, kind="stable")
    seeds, first = np.unique(h[by], return_index=True)
    words, codes = np.unique(np.concatenate([*items, np.zeros(0, np.uint64)]), return_inverse=True)
    starts = np.append(0, np.cumsum([len(x) for x in items])).astype(np.int64)
    return Block(ids, items, seeds, np.append(first, len(by)), item[by], place[by], words, codes, starts)


def _seed_hits(block: Block, hashes, first, n):
    """Where n-grams that are seeds start in a slice, and which seeds they are."""
    h, at = windows(hashes, first, n)
    seed = lookup(block.seeds, h)
    return at[seed >= 0], seed[seed >= 0]


def _held(rows: DataFrame, block: Block, n: int) -> tuple[np.ndarray, int]:
    """How many of the rows' texts hold each seed of the block, and how many rows there are."""
    shared, width = rows.sparkSession.sparkContext.broadcast(block), len(block.seeds)

    def run(batches):
        counts = np.zeros(width + 1, dtype=np.int64)
        for batch in slices(batches):
            hashes, first = _hashes(batch.column("text"))
            at, seed = _seed_hits(shared.value, hashes, first, n)
            counts += np.bincount(np.unique(row_of(first)[at] * width + seed) % max(width, 1), minlength=width + 1)
            counts[width] += batch.num_rows
        some = np.flatnonzero(counts)
        yield batch_of(pa.schema([("seed", pa.int32()), ("n", pa.int64())]), some.astype(np.int32), counts[some])

    found = rows.select("text").mapInArrow(run, "seed int, n long").groupBy("seed").agg(F.sum("n").alias("n")).toArrow()
    shared.destroy()
    counts = np.zeros(width + 1, dtype=np.int64)
    counts[found["seed"].to_numpy()] = found["n"].to_numpy()
    return counts[:width], int(counts[width])


def _rare(block: Block, held: np.ndarray, docs: int, n: int, min_score: float) -> Block:
    """The block with rare seeds and the rarest of each stretch; held: documents that hold each seed, of so many docs."""
    places = np.diff(block.first)
    seed = np.repeat(np.arange(len(places)), places)
    keep = (held * places <= docs)[seed]
    order = np.lexsort((block.place, block.item))
    item, cost = block.item[order], held[seed[order]]
    at = np.arange(len(order))
    size = np.diff(block.starts)
    stretch = np.clip(np.ceil(size * min_score).astype(np.int64) - n + 1, 1, STRETCH)[item]
    rarest, whole = at.copy(), block.place[order] + stretch + n - 1 <= size[item]
    for k in range(1, STRETCH):
        other = np.minimum(at + k, len(at) - 1)
        better = whole & (k < stretch) & (cost[other] < cost[rarest])
        rarest[better] = other[better]
    keep[order[rarest[whole]]] = True
    left = np.bincount(seed[keep], minlength=len(places))
    return replace(block, seeds=block.seeds[left > 0], first=np.append(0, np.cumsum(left[left > 0])), item=block.item[keep], place=block.place[keep])


def _seeded(rows: DataFrame, ids, items, n: int, min_score: float) -> Block:
    """A block with the seeds that are rare in the texts of rows."""
    block = _block(ids, items, n)
    return _rare(block, *_held(rows, block, n), n, min_score)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, and the passage's words it spans.

    A row of scores is made at once: gaps along the passage are a running maximum.
    Each cell carries where its alignment began, so no table is kept.
    """
    width = len(passage)
    steps = np.arange(width + 1) * -GAP
    score, origin = np.zeros(width + 1, dtype=np.int64), np.arange(width + 1)
    best = (0, 0, 0)
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        new, start = score + GAP, origin.copy()
        diagonal = score[:-1] + step
        better = diagonal >= new[1:]
        new[1:][better] = diagonal[better]
        start[1:][better] = origin[:-1][better]
        empty = new <= 0
        new[empty] = 0
        start[empty] = np.flatnonzero(empty)
        lifted = new + steps
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(width + 1), 0))
        score, origin = top - steps, start[source]
        k = int(score.argmax())
        if score[k] > best[0]:
            best = (int(score[k]), int(origin[k]), k)
    return best


def _likely(block: Block, held: np.ndarray, row, item, min_score) -> np.ndarray:
    """Whether each row holds min_score of its item's words, as any alignment of that score must; held: sorted keys of row and word."""
    size = np.diff(block.starts)[item]
    out = np.zeros(len(row), dtype=bool)
    ends = np.cumsum(size)
    a = 0
    while a < len(row):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - size[a] + HITS, "right")))
        code = block.codes[np.repeat(block.starts[item[a:b]], size[a:b]) + ranges(size[a:b])]
        found = lookup(held, np.repeat(row[a:b], size[a:b]) * len(block.words) + code) >= 0
        out[a:b] = per_row(found, np.append(0, np.cumsum(size[a:b]))) / size[a:b] >= min_score
        a = b
    return out


def _pairs(block: Block, hashes, first, n, min_score):
    """(row, item, score, first word, end word) of a slice's passages; the best place for each row and item."""
    at, seed = _seed_hits(block, hashes, first, n)
    found: dict = {}
    if not len(at):
        return found
    of = row_of(first)
    code = lookup(block.words, hashes)
    held = np.unique((of * len(block.words) + code)[code >= 0])
    count = block.first[seed + 1] - block.first[seed]
    rows, begin = np.unique(of[at], return_index=True)
    before, begin = np.append(0, np.cumsum(count)), np.append(begin, len(at))
    a = 0
    while a < len(rows):
        b = max(a + 1, int(np.searchsorted(before[begin], before[begin[a]] + HITS, "right")) - 1)
        hits = slice(begin[a], begin[b])
        found.update(_aligned(block, hashes, first, n, min_score, held, of, at[hits], seed[hits], count[hits]))
        a = b
    return found


def _aligned(block: Block, hashes, first, n, min_score, held, of, at, seed, count):
    """What _pairs gives, for the seeds found in some of the rows."""
    place = np.repeat(block.first[seed], count) + ranges(count)
    word, item, inside = np.repeat(at, count), block.item[place], block.place[place]
    row = of[word]
    pairs, pair = np.unique(row * len(block.items) + item, return_inverse=True)
    ok = _likely(block, held, pairs // len(block.items), pairs % len(block.items), min_score)[pair]
    word, item, inside, row = word[ok], item[ok], inside[ok], row[ok]
    size = np.array([len(x) for x in block.items], dtype=np.int64)[item]
    pad = size // 2 + n
    low = np.maximum(word - inside - pad, first[row])
    high = np.minimum(word - inside + size + pad, first[row + 1])
    found: dict = {}
    by = np.lexsort((low, item, row))
    k = 0
    while k < len(by):
        r, i, a, b = row[by[k]], item[by[k]], low[by[k]], high[by[k]]
        limit = a + 4 * size[by[k]] + 4 * n
        k += 1
        while k < len(by) and row[by[k]] == r and item[by[k]] == i and low[by[k]] <= b and high[by[k]] <= limit:
            b = max(b, high[by[k]])
            k += 1
        if np.isin(block.items[i], hashes[a:b]).mean() < min_score:
            continue  # too few of the item's words are here for any alignment to reach min_score
        got, start, end = align(block.items[i], hashes[a:b])
        share = got / (MATCH * len(block.items[i]))
        if share >= min_score and share > found.get((r, i), (0,))[0]:
            found[r, i] = (share, int(a + start - first[r]), int(a + end - first[r]))
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = N, min_score: float = MIN_SCORE) -> DataFrame:
    """Pairs of passages and items: doc_id, item_id, score, first_word, end_word (of the passage)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fields = [T.StructField("item_id", benchmark.schema[item_id].dataType), *T.StructType.fromDDL("score double, first_word long, end_word long").fields]
    schema = T.StructType([*rows.select("doc_id").schema.fields, *fields])
    item_type = to_arrow_type(benchmark.schema[item_id].dataType)
    out = None
    for ids, items in blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(_seeded(rows, ids, items, n, min_score))

        def run(batches, shared=shared):
            block = shared.value
            for batch in slices(batches):
                found = _pairs(block, *_hashes(batch.column("text")), n, min_score)
                keys = sorted(found)
                columns = [batch.column("doc_id").take(pa.array([k[0] for k in keys], pa.int64())), pa.array([block.ids[k[1]] for k in keys], item_type)]
                values = [found[k] for k in keys]
                columns += [pa.array([v[0] for v in values], pa.float64()), *(pa.array([v[j] for v in values], pa.int64()) for j in (1, 2))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "score", "first_word", "end_word"])

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", n: int = N, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of docs that pair with no item, columns unchanged."""
    names, rows = docs.columns, docs.select(F.col(text_col).alias("text"))
    for ids, items in blocks(benchmark, "item_id", "text"):
        shared = docs.sparkSession.sparkContext.broadcast(_seeded(rows, ids, items, n, min_score))

        def run(batches, shared=shared):
            for batch in slices(batches, text_col):
                found = _pairs(shared.value, *_hashes(batch.column(text_col)), n, min_score)
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[k[0] for k in found]] = False
                yield batch.filter(pa.array(keep)).rename_columns(names)

        docs = docs.mapInArrow(run, docs.schema)
    return docs
