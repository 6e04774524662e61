"""Language identification as mixture inference.

A language is a table of log-likelihoods of hashed letter trigrams, learnt
from labelled documents. A document is a mixture: each of its words comes from
one language, with a likelihood that is the product of its trigrams'. For each
document expectation-maximisation estimates the proportions; then the least
language is dropped again and again, and the set with the best penalised
likelihood (a fixed cost per language that grows with the log of the number
of words) is kept. The prediction is the language of the greatest proportion,
its score that proportion.

All learning rows are counted, by tasks that add up to one table per
language; the table's size is ``BUCKETS`` numbers per language, whatever the
corpus. Whole texts are read.

Defined cases: null text or text without a letter gives ``und`` with score
0; null language or null id is not learnt from; without any learnt language
everything is ``und``; repeated rows count and are predicted each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.llm.common import materialise, ship

BUCKETS = 1 << 16
SMOOTH = 0.05      # added to every trigram count
ROUNDS = 6         # of expectation-maximisation per language set
PENALTY = 2.0      # log-likelihood a language costs, times log(words + 1)
TEMPER = 0.5       # neighbouring trigrams overlap: weight of each one's evidence
CHUNK = 2 << 20
UND = "und"

# Bytes by role: ASCII capitals become small, other ASCII non-letters blank.
_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def trigrams(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams around each letter byte, and where each such byte is."""
    buf = np.empty(len(raw) + 2, dtype=np.uint8)
    buf[0] = buf[-1] = 0x20
    buf[1:-1] = _FOLD[np.frombuffer(raw, dtype=np.uint8)]
    at = np.flatnonzero(buf[1:-1] != 0x20)
    code = (buf[:-2].astype(np.uint32) << np.uint32(16)) | (
        buf[1:-1].astype(np.uint32) << np.uint32(8)) | buf[2:]
    code = code[at] * np.uint32(0x9E3779B1)
    return (code >> np.uint32(16)).astype(np.int64), at


def _chunks(batch: pa.RecordBatch, extra: int) -> Iterator[tuple]:
    """(columns before the text, texts) of about ``CHUNK`` bytes; text is column ``extra``."""
    rows, texts, size = [], [], 0
    fixed = [batch.column(i).to_pylist() for i in range(extra)]
    for i, text in enumerate(batch.column(extra)):
        raw = text.as_buffer()
        rows.append([c[i] for c in fixed])
        texts.append(raw.to_pybytes() if raw is not None else b"")
        size += len(texts[-1])
        if size >= CHUNK:
            yield rows, texts
            rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for rows, texts in _chunks(batch, 1):
            by: dict[str, list[bytes]] = {}
            for (lang,), raw in zip(rows, texts):
                by.setdefault(lang, []).append(raw)
            for lang, raws in by.items():
                grams, _ = trigrams(b"\n".join(raws))
                counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                counts[lang] += np.bincount(grams, minlength=BUCKETS)
    for lang, n in counts.items():
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()),
             pa.array(n[some], pa.int64())], names=["lang", "bucket", "n"])


def learn(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple:
    """(languages, log-likelihood table [BUCKETS, languages]) of labelled rows."""
    ship(rows.sparkSession)
    counted = materialise(
        rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
        .mapInArrow(_count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "trigrams")
    table = counted.toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    where = {x: i for i, x in enumerate(names)}
    counts = np.full((BUCKETS, len(names)), SMOOTH)
    langs = np.array([where[x] for x in table.column("lang").to_pylist()], dtype=np.int64)
    counts[table.column("bucket").to_numpy(), langs] += table.column("n").to_numpy()
    return names, (TEMPER * np.log(counts / counts.sum(axis=0))).astype(np.float32)


def mixtures(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """Proportions of the selected languages of each text (zero rows: no letter byte)."""
    n_lang = table.shape[1]
    out = np.zeros((len(texts), n_lang))
    grams, at = trigrams(b" ".join(texts))
    if not len(grams):
        return out
    word = np.ones(len(at), dtype=bool)
    word[1:] = np.diff(at) > 1
    first = np.flatnonzero(word)
    like = np.stack([np.add.reduceat(table[:, k][grams], first) for k in range(n_lang)], axis=1)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    doc = np.searchsorted(begin, at[first], side="right") - 1
    docs, start, words = np.unique(doc, return_index=True, return_counts=True)
    local = np.repeat(np.arange(len(docs)), words)
    top = like.max(axis=1, keepdims=True)
    weight = np.exp(like - top)

    def em(share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(ROUNDS):
            joint = weight * share[local]
            total = joint.sum(axis=1, keepdims=True)
            np.divide(joint, np.maximum(total, 1e-30), out=joint)
            share = np.add.reduceat(joint, start, axis=0) / words[:, None]
        total = np.maximum((weight * share[local]).sum(axis=1), 1e-30)
        return share, np.add.reduceat(np.log(total) + top[:, 0], start)

    share = np.full((len(docs), n_lang), 1.0 / n_lang, dtype=np.float32)
    best = np.full(len(docs), -np.inf)
    chosen = np.zeros_like(share)
    cost = PENALTY * np.log(words + 1.0)
    for size in range(n_lang, 0, -1):
        share, fit = em(share)
        value = fit - cost * (share > 0).sum(axis=1)
        better = value > best
        best[better], chosen[better] = value[better], share[better]
        if size == 1:
            break
        # drop the least language still in, and all that have next to nothing
        alive = np.where(share > 0, share, np.inf)
        several = (share > 0).sum(axis=1) > 1
        drop = (alive == alive.min(axis=1, keepdims=True)) & several[:, None]
        drop[np.arange(len(docs)), share.argmax(axis=1)] = False
        share = np.where(drop, 0, share)
        # a language dropped earlier may come back only by a better set, never here
        share = share / share.sum(axis=1, keepdims=True)
    out[docs] = chosen
    return out


def predict(docs: DataFrame, model: tuple, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, languages (those of the selected set, by proportion)."""
    names, table = model
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in _chunks(batch, 2):
                shares = mixtures(texts, shared.value) if names else None
                pred, score, found = [], [], []
                for i, (_, letter) in enumerate(rows):
                    if not letter or shares is None:
                        pred.append(UND)
                        score.append(0.0)
                        found.append([])
                        continue
                    share = shares[i]
                    if not share.any():  # letters, but none the table knows how to read
                        share = np.full(len(names), 1.0 / len(names))
                    order = np.argsort(-share, kind="stable")
                    pred.append(names[order[0]])
                    score.append(float(min(1.0, share[order[0]])))
                    found.append([names[k] for k in order if share[k] > 0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array(pred, pa.string()),
                     pa.array(score, pa.float64()), pa.array(found, pa.list_(pa.string()))],
                    names=["doc_id", "lang_pred", "score", "languages"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letter"),
                       text.alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, languages array<string>")


def held_out(id_col: str = "doc_id"):
    """The documents that are not learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """Learn from the documents that are not held out and predict all of them."""
    known = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))
    model = learn(known, text_col, lang_col)
    return predict(docs, model, id_col, text_col).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "languages")
