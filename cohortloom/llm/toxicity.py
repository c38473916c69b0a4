"""Toxicity scores from non-negative positive-unlabelled learning.

A logistic classifier over the presence of words is trained with numpy from
confirmed toxic texts and unlabelled texts. The risk of the unlabelled texts as
negatives, less the class prior times that of the toxic ones, estimates the risk
of the clean ones; where a step would make it negative, the step is undone
instead.

Every word counts: its hash gives it one of ``BINS`` weights. A bin's input is scaled
by how far its share of toxic texts deviates from its share of all documents (``scales``),
so that words that tell nothing have little say. Those shares come from all documents;
only the texts that the risk is computed on are samples, of ``max_positive`` confirmed
and ``max_unlabelled`` unlabelled texts, so the model and what reaches the driver are
bounded. Texts are drawn by a hash of id and text, so one id of many texts is drawn like
any other rows, and rows that agree in both enter a sample once. A null id is no confirmed one.

Null and empty texts have no word and get the score of the bias alone. Words are
runs of ASCII letters and characters outside ASCII, A-Z lower-cased. Without a
positive or an unlabelled text all scores are the prior. Very long texts are read
whole. Repeated rows score alike; other columns are ignored in training and kept in
scoring, but for score and predicted, which are replaced. An empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import ALPHA, Spans, batch_of, cut, more, row_of, slices, text_bytes, word_spans

MAX_POSITIVE = 4000
MAX_UNLABELLED = 8000
BINS = 1 << 20
#: Deviations at which a bin's input is halved.
HALF = 4.0
#: So many toxic documents with a word are taken for chance.
FEW = 2.0
STEPS = 300
DECAY = 1e-6


@dataclass(frozen=True)
class Model:
    """A weight for each bin, scale included, and a bias."""

    weights: np.ndarray
    bias: float


def _present(column) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bin) of a slice, by row."""
    data, offsets = text_bytes(column)
    start, end, first = word_spans(data, offsets, ALPHA)
    bins = (Spans(data).hashes(start, end) % np.uint64(BINS)).astype(np.int64)
    both = np.unique(row_of(first) * BINS + bins)
    return both // BINS, both % BINS


def _bin_counts(batches):
    """Documents with each bin, one row a bin and task."""
    counts = np.zeros(BINS, dtype=np.int64)
    for batch in slices(batches):
        counts += np.bincount(_present(batch.column("text"))[1], minlength=BINS)
    some = np.flatnonzero(counts)
    yield batch_of(pa.schema([("bin", pa.int32()), ("n", pa.int64())]), some.astype(np.int32), counts[some])


def _bins(batches):
    for batch in slices(batches):
        row, bins = _present(batch.column("text"))
        ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
        bins = bins.astype(np.uint32)
        yield batch_of(pa.schema([("draw", pa.int64()), ("positive", pa.bool_()), ("bins", pa.binary())]), batch.column("draw"), batch.column("positive"), [bins[a:b].tobytes() for a, b in zip(ends, ends[1:])])


def _draw(docs: DataFrame, positives: DataFrame, max_positive: int, max_unlabelled: int) -> DataFrame:
    """At most max_positive texts of toxic documents and max_unlabelled of all documents, by a hash of id and text.

    The unlabelled sample comes from all documents, so that its share of toxic ones is the prior. Hashes alone are
    drawn; their texts are found by a broadcast of these, whose number is bounded, and equal rows of a hash become one.
    """
    rows = docs.select("*", F.xxhash64("id", "text", F.lit("toxicity")).alias("draw"))
    toxic = rows.select("id", "draw").join(positives.distinct(), "id", "left_semi")
    drawn = [found.select("draw").distinct().orderBy("draw").limit(most).withColumn("positive", F.lit(kind)) for kind, found, most in ((True, toxic, max_positive), (False, rows, max_unlabelled))]
    return rows.join(F.broadcast(cut(drawn[0].unionByName(drawn[1]))), "draw").groupBy("draw", "positive").agg(F.any_value("text").alias("text"))


def scales(p: np.ndarray, n_p: int, u: np.ndarray, n_u: int) -> np.ndarray:
    """0 to 1 for each bin: how far its share p / n_p of toxic documents deviates from its share u / n_u of all."""
    share = (p + u) / (n_p + n_u)
    z = (p / n_p - u / n_u) / np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u) + (FEW / n_p) ** 2)
    return z**2 / (z**2 + HALF**2)


def fit(docs: DataFrame, positives: DataFrame, prior: float, text_col: str = "text", id_col: str = "doc_id", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Fit on docs; positives holds the ids (id_col) of confirmed toxic ones, all others count as unlabelled. prior: between 0 and 1."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table = _draw(rows, positives.select(F.col(id_col).alias("id")), max_positive, max_unlabelled).mapInArrow(_bins, "draw long, positive boolean, bins binary").toArrow()
    table = table.sort_by([("positive", "ascending"), ("draw", "ascending")])  # sums of a rerun agree
    y = table["positive"].to_numpy(zero_copy_only=False).astype(bool)
    if not y.any() or y.all():
        return Model(np.zeros(BINS, dtype=np.float32), float(np.log(prior / (1 - prior))))
    texts = [np.frombuffer(x, dtype=np.uint32).astype(np.int64) for x in table["bins"].to_pylist()]
    found = rows.select("text").mapInArrow(_bin_counts, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    everywhere = np.zeros(BINS)
    everywhere[found["bin"].to_numpy()] = found["n"].to_numpy()
    p, u = ([t for t, x in zip(texts, y) if x == kind] for kind in (True, False))
    scale = scales(np.bincount(np.concatenate(p), minlength=BINS), len(p), everywhere, max(rows.count(), 1))
    bins = np.unique(np.concatenate(texts))
    weights, bias = train(Matrix(p, bins, scale[bins]), Matrix(u, bins, scale[bins]), prior)
    all_weights = np.zeros(BINS, dtype=np.float32)
    all_weights[bins] = weights * scale[bins]
    return Model(all_weights, bias)


class Matrix:
    """Rows of bins, each with its scale as value: products from either side."""

    def __init__(self, rows: list[np.ndarray], bins: np.ndarray, scale: np.ndarray):
        self.at = np.searchsorted(bins, np.concatenate([*rows, np.zeros(0, np.int64)]))
        self.value, self.n, self.width = scale[self.at], len(rows), len(bins)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.at] * self.value, minlength=self.n)

    def __rmatmul__(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=g[self.row] * self.value, minlength=self.width)


def train(p: Matrix, u: Matrix, prior: float, steps: int = STEPS, rate: float = 0.1, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise prior * R(p as 1) + max(0, R(u as 0) - prior * R(p as 0)) by Adam, logistic loss."""
    w, b = np.zeros(p.width), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(p.width + 1), np.zeros(p.width + 1)
    for t in range(1, steps + 1):
        zp, zu = p @ w + b, u @ w + b
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = prior * sp / p.n, su / u.n
        if clean >= 0:
            gp = prior * (sp - 1) / p.n - gp
        else:  # the estimate of a risk can't be negative: step back
            gu = -gu
        grad = np.append(p.__rmatmul__(gp) + u.__rmatmul__(gu) + decay * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def score_batch(model: Model, column: pa.Array) -> np.ndarray:
    row, bins = _present(column)
    z = model.bias + np.bincount(row, weights=model.weights[bins], minlength=len(column))
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of docs, with ``score`` and ``predicted`` added (or replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("score", "predicted")]

    def run(batches):
        for batch in slices(batches, text_col):
            s = score_batch(shared.value, batch.column(text_col))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*names, "score", "predicted"])

    kept = docs.select(*names)
    return kept.mapInArrow(run, more(kept, "score double, predicted int"))
