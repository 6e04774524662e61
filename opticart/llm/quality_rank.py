"""Quality scores by Bradley-Terry ranking of labelled documents.

A preference pair is a document labelled good and one labelled bad; the model
says the good one wins with probability sigmoid(w (x_good - x_bad)) and is
fitted by Newton steps on the logistic loss of the feature differences. A
raw score is w x. The cut is the quantile of the labelled raw scores that
leaves the labelled share of bad documents below it, and scores are shifted so
that the cut becomes ``CUT``.

Every labelled document and every pair counts. A pair's loss depends on its two
raw scores alone, so documents are counted and their features added up in
``BINS`` bins of the raw score: these sums give the gradient over all pairs
(each score taken at its bin's middle) and weigh the documents in the Hessian.
Two jobs make a step, and what they return is of the same size for any corpus.
Mean, scale, cut and spread are those of all labelled documents, the cut by
exact selection.

Features are shares of character classes, of pairs of neighbouring classes,
and of repeated words and lines, over the whole text; they are written once,
as 32-bit numbers, for learning and scoring.

Defined cases: a null text is an empty one; null labels and null ids are not
learnt from; labels that repeat count once per row; with only one class, or
none, every raw score is 0 and every score the share of good labels (0.5
without labels); repeated documents are scored each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.functions.selection import at_rank
from opticart.llm.common import discard, materialise, ship
from opticart.llm.wordhash import word_hashes, word_spans

BINS = 128        # bins of the raw score, a pair's weight is that of their middles
WIDTH = 0.25      # their width; scores beyond the outer ones belong to these
RIDGE = 1e-3
STEPS = 12
TOLERANCE = 1e-3  # of a step's largest weight change, about what the bins leave open
FINAL = 4         # tasks that add up the tasks' sums
SLOPE = 4.0       # score units a standard deviation of the labelled raw scores spans
CUT = 0.3
CHUNK = 2 << 20


def _classes() -> np.ndarray:
    kind = np.zeros(256, dtype=np.uint8)          # 0: other punctuation and controls
    kind[ord("a"):ord("z") + 1] = 1
    kind[ord("A"):ord("Z") + 1] = 2
    kind[ord("0"):ord("9") + 1] = 3
    kind[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 4
    kind[0x0A] = 5
    kind[[ord(c) for c in ".!?"]] = 6
    kind[[ord(c) for c in ",;:"]] = 7
    kind[[ord(c) for c in "#*$%&"]] = 8
    kind[[ord(c) for c in "|<>"]] = 9
    kind[[ord(c) for c in "()[]{}\"'"]] = 10
    kind[0x80:] = 11
    return kind


_KIND = _classes()
N_KINDS = 12
N_FEATURES = N_KINDS * N_KINDS + N_KINDS + 6


def features(texts: list[bytes]) -> np.ndarray:
    """One row of features per text."""
    n = len(texts)
    out = np.zeros((n, N_FEATURES))
    raw = b"\n".join(texts)
    if not raw:
        return out
    buf = np.frombuffer(raw, dtype=np.uint8)
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    kind = _KIND[buf].astype(np.int64)
    doc = np.repeat(np.arange(n), np.append(sizes[:-1] + 1, sizes[-1]))
    last = begin + sizes                            # the joining line end after each text
    own = np.ones(len(buf), dtype=bool)
    own[last[:-1]] = False
    pair = kind[:-1] * N_KINDS + kind[1:]
    both = own[:-1] & own[1:]
    k2 = N_KINDS * N_KINDS
    pairs = np.bincount(doc[:-1][both] * k2 + pair[both], minlength=n * k2).reshape(n, k2)
    single = np.bincount(doc[own] * N_KINDS + kind[own],
                         minlength=n * N_KINDS).reshape(n, N_KINDS)
    out[:, :k2] = pairs / np.maximum(sizes - 1, 1)[:, None]
    out[:, k2:k2 + N_KINDS] = single / np.maximum(sizes, 1)[:, None]
    starts, ends = word_spans(buf)
    if len(starts):
        h = word_hashes(buf, starts, ends)
        wdoc = doc[starts]
        words = np.bincount(wdoc, minlength=n)
        per = np.maximum(words, 1)
        order = np.lexsort((h, wdoc))
        fresh = np.ones(len(h), dtype=bool)
        fresh[1:] = (h[order][1:] != h[order][:-1]) | (wdoc[order][1:] != wdoc[order][:-1])
        distinct = np.bincount(wdoc[order][fresh], minlength=n)
        again = np.bincount(wdoc[1:][(h[1:] == h[:-1]) & (wdoc[1:] == wdoc[:-1])], minlength=n)
        length = np.bincount(wdoc, weights=ends - starts, minlength=n)
        some = words > 0
        out[:, k2 + N_KINDS] = np.where(some, 1 - distinct / per, 0)
        out[:, k2 + N_KINDS + 1] = again / per
        out[:, k2 + N_KINDS + 2] = np.minimum(length / per, 30) / 30
        out[:, k2 + N_KINDS + 3] = np.log1p(words) / 10
        out[:, k2 + N_KINDS + 4] = words < 10
        out[:, k2 + N_KINDS + 5] = np.minimum(single[:, 5] / per, 1)
    return out


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float          # raw score that becomes CUT
    slope: float
    flat: float | None  # the score of everything if there is nothing to rank

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.flat is not None:
            return np.full(len(x), self.flat)
        z = (self.raw(x) - self.cut) * self.slope + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(-1, N_FEATURES).astype(np.float64)


def _added(rows: DataFrame, part, size: int) -> np.ndarray:
    """The sum over all (good, x) rows of ``part(good, x)``, an array of ``size`` numbers:
    added up in every task, then in ``FINAL`` tasks, then here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch, 1))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["t"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += batch.column(0).flatten().to_numpy().reshape(-1, size).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["t"])

    sums = (rows.select("good", "x").mapInArrow(run, "t array<double>").repartition(FINAL)
            .mapInArrow(again, "t array<double>").toArrow())
    return sums.column("t").combine_chunks().flatten().to_numpy().reshape(-1, size).sum(axis=0)


def fit(rows: DataFrame) -> Model:
    """Bradley-Terry weights from all (good, bad) pairs of the labelled rows (good, x)."""
    size = N_FEATURES
    total = _added(rows, lambda good, x: np.concatenate(
        [[len(good), good.sum()], x.sum(axis=0), (x * x).sum(axis=0)]), 2 + 2 * size)
    n, n_good = int(total[0]), int(total[1])
    none = np.zeros(size)
    if not n_good or n_good == n:
        return Model(none, none + 1, none, 0.0, 1.0, n_good / n if n else 0.5)
    mean = total[2:2 + size] / n
    scale = np.sqrt(np.maximum(total[2 + size:] / n - mean * mean, 0))
    scale = np.where(scale > 1e-7, scale, 1.0)
    middle = (np.arange(BINS) - (BINS - 1) / 2) * WIDTH
    win = 1 / (1 + np.exp(np.clip(middle[None, :] - middle[:, None], -40, 40)))
    ridge = RIDGE * np.eye(size)

    def placed(good: np.ndarray, x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The scaled features and the bin of each row, those of good ones after the others."""
        z = np.clip((x - mean) / scale, -8, 8)
        at = np.clip(np.floor(z @ w / WIDTH).astype(np.int64) + BINS // 2, 0, BINS - 1)
        return z, at + BINS * good

    def in_bins(w: np.ndarray):
        def part(good: np.ndarray, x: np.ndarray) -> np.ndarray:
            z, at = placed(good, x, w)
            sums = np.zeros((2 * BINS, 1 + size))
            order = np.argsort(at, kind="stable")
            used, begin = np.unique(at[order], return_index=True)
            sums[used, 0] = np.diff(np.append(begin, len(at)))
            sums[used, 1:] = np.add.reduceat(z[order], begin, axis=0)
            return sums.ravel()
        return part

    def squares(w: np.ndarray, weight: np.ndarray):
        def part(good: np.ndarray, x: np.ndarray) -> np.ndarray:
            z, at = placed(good, x, w)
            return (z.T @ (z * weight[at][:, None])).ravel()
        return part

    w, pairs = none, float(n_good) * (n - n_good)
    for _ in range(STEPS):
        sums = _added(rows, in_bins(w), 2 * BINS * (1 + size)).reshape(2, BINS, 1 + size)
        (bad, z_bad), (good, z_good) = ((s[:, 0], s[:, 1:]) for s in sums)
        lose, both = 1 - win, win * (1 - win)           # by the bins of a good and a bad one
        gradient = ((lose @ bad) @ z_good - (good @ lose) @ z_bad) / pairs - RIDGE * w
        weight = np.concatenate([good @ both, both @ bad]) / pairs
        cross = z_good.T @ both @ z_bad / pairs
        hessian = (_added(rows, squares(w, weight), size * size).reshape(size, size)
                   - cross - cross.T + ridge)
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < TOLERANCE:
            break
    model = Model(mean, scale, np.round(w, 9), 0.0, 1.0, None)  # whatever order sums came in
    raw = materialise(rows.select("x").mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array(model.raw(_matrix(b, 0)))],
                                                    names=["raw"]) for b in batches),
        "raw double"), "raw-scores")
    k = n - n_good  # so many labelled rows lie below the cut
    cut = (at_rank(raw, "raw", k) + at_rank(raw, "raw", k + 1)) / 2
    spread = max(float(raw.agg(F.stddev_pop("raw")).first()[0]), 1e-9)
    discard(raw)
    return Model(mean, scale, model.weights, float(cut), SLOPE / spread, None)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """Row ranges of a batch with their texts, of about ``CHUNK`` bytes."""
    first, texts, size = 0, [], 0
    for i, text in enumerate(batch.column(column)):
        raw = text.as_buffer()
        texts.append(raw.to_pybytes() if raw is not None else b"")
        size += len(texts[-1])
        if size >= CHUNK:
            yield first, i + 1, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, batch.num_rows, texts


def held_out(id_col: str):
    """The documents whose labels are not learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def featurise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and features (x) of every document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in _texts(batch, 1):
                x = features(texts).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES,
                                              x.ravel())], names=["doc_id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, x array<float>")


def learn(featured: DataFrame, labels: DataFrame, id_col: str = "doc_id",
          label_col: str = "quality") -> Model:
    """Fit on all labelled documents (doc_id, x) that are not held out."""
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
                          & ~held_out(id_col)).select(
        F.col(id_col).cast("long").alias("doc_id"), (F.col(label_col) == 1).alias("good"))
    rows = materialise(featured.join(chosen, "doc_id").select("good", "x"), "labelled")
    model = fit(rows)
    discard(rows)
    return model


def score(featured: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document (doc_id, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(_matrix(batch, 1)))],
                names=["doc_id", "score"])

    return featured.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def rank(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    featured = materialise(featurise(docs, id_col, text_col), "features")
    scored = score(featured, learn(featured, labels, id_col))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))
