"""Removal of repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document; a word goes if a
window that covers it starts anywhere else too. The minimiser of a window is
the least hash of its runs of ``GRAM`` words. Consecutive windows with one
minimiser travel as one string of words to the minimiser's bucket; equal
windows have equal minimisers, so each bucket sees all occurrences of its
windows, sorts their hashes, confirms equal neighbours word by word and sends
the covered ranges back to the documents.

Hot minimisers: a first pass counts them. Runs of words that are minimisers
too often rank behind all others, so a window chooses one only if it has
nothing else. A passage that is everywhere has only such runs, so a second
pass counts the minimisers of this new order. The windows of those that are
hot still spread over as many sub-buckets as their count asks for, by row (id,
text hash and the row's number among equal ones of its task); each sub-bucket
settles the windows it sees twice and reports each distinct window once, and
the reports are added up natively. So a passage in a third of all documents
fills no single task, whether these are copies of one text or differ.

Defined cases: a null text has no words; a document is a row: a repeated row
is another occurrence of all its windows; an empty table gives an empty
result; other columns are ignored. Nothing is capped: the list of hot
minimisers is cut to ``HOT_LIST`` entries, which affects balance only.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.llm.common import materialise, ship
from opticart.llm.wordhash import mix, rolling, sliding_min, word_hashes, word_spans

WINDOW = 35
GRAM = 5
HOT_AT = 2000          # occurrences that make a minimiser hot
HOT_SHARE = 500        # occurrences of a hot minimiser in one sub-bucket, about
HOT_LIST = 1 << 20     # hot minimisers told to the tasks (16 MB)
BUCKET_WORDS = 1_500_000
MIN_BUCKETS = 64
CHUNK = 4 << 20        # bytes of text hashed at once

_TOP = np.uint64(1 << 63)


class Chunk:
    """Some documents' text in one buffer, with word hashes and windows."""

    def __init__(self, keys: list[tuple], texts: list[bytes]):
        self.keys = keys
        self.raw = b"\n".join(texts)
        buf = np.frombuffer(self.raw, dtype=np.uint8)
        self.starts, self.ends = word_spans(buf)
        self.hashes = word_hashes(buf, self.starts, self.ends)
        last = np.cumsum([len(t) + 1 for t in texts])  # byte after each document
        self.doc = np.searchsorted(last, self.starts, side="right")
        self.first_word = np.searchsorted(self.doc, np.arange(len(texts)))

    def runs(self, hot: np.ndarray) -> tuple[np.ndarray, ...]:
        """First window, last window + 1 and minimiser of each super-k-mer."""
        none = np.empty(0, dtype=np.int64)
        n = len(self.hashes) - WINDOW + 1
        if n <= 0:
            return none, none, none.astype(np.uint64)
        grams = rolling(self.hashes, GRAM) >> np.uint64(1)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
            grams = np.where(hot[at] == grams, grams | _TOP, grams)
        least = sliding_min(grams, WINDOW - GRAM + 1)
        whole = self.doc[:n] == self.doc[WINDOW - 1:]  # inside one document
        new = np.ones(n, dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (self.doc[1:n] != self.doc[:n - 1]) \
            | (whole[1:] != whole[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], n)
        keep = whole[begin]
        return begin[keep], end[keep], least[begin[keep]]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Documents (doc_id, text hash, text) in buffers of about ``CHUNK`` bytes."""
    for batch in batches:
        keys, texts, size = [], [], 0
        ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for doc, mark, text in zip(ids, marks, batch.column(2)):
            raw = text.as_buffer()
            if raw is None or raw.size < 2 * WINDOW - 1:
                continue  # too short for a window
            keys.append((doc, mark))
            texts.append(raw.to_pybytes())
            size += raw.size
            if size >= CHUNK:
                yield Chunk(keys, texts)
                keys, texts, size = [], [], 0
        if keys:
            yield Chunk(keys, texts)


def _count(hot: np.ndarray):
    """mapInArrow function: minimisers if ``hot`` ones rank last, and (key null) words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            _, _, least = chunk.runs(hot)
            values, counts = np.unique(least & ~_TOP, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*values.view(np.int64).tolist(), None], pa.int64()),
                 pa.array([*counts.tolist(), len(chunk.hashes)], pa.int64())], names=["key", "n"])

    return run


def _row_salts(chunk: Chunk, rows: np.ndarray, seen: Counter, task: int) -> np.ndarray:
    """A number per document of the chunk, its own for each of ``rows`` even if all are copies."""
    salts = np.zeros(len(chunk.keys), dtype=np.uint64)
    mine = [chunk.keys[i] for i in rows.tolist()]
    nth = np.empty(len(mine), dtype=np.uint64)
    for i, key in enumerate(mine):
        nth[i] = seen[key]
        seen[key] += 1
    docs = np.array([-1 if d is None else d for d, _ in mine], dtype=np.int64).view(np.uint64)
    marks = np.array([m for _, m in mine], dtype=np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        salts[rows] = mix(mix(mix(docs) ^ marks) + mix(nth + (np.uint64(task) << np.uint64(40))))
    return salts


def _spread(hot: np.ndarray, wide_keys: np.ndarray, wide_parts: np.ndarray, buckets: int):
    """mapInArrow function: the super-k-mers of the documents, packed per bucket.

    ``hot`` minimisers rank last; those in ``wide_keys`` are dealt to parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=3)
        task = TaskContext.get().partitionId()
        seen: Counter = Counter()
        for chunk in _chunks(batches):
            begin, end, least = chunk.runs(hot)
            if not len(begin):
                continue
            doc = chunk.doc[begin]
            key = least & ~_TOP
            is_hot = np.zeros(len(key), dtype=bool)
            if len(wide_keys):
                at = np.minimum(np.searchsorted(wide_keys, key), len(wide_keys) - 1)
                is_hot = wide_keys[at] == key
            if is_hot.any():
                salts = _row_salts(chunk, np.unique(doc[is_hot]), seen, task)
                with np.errstate(over="ignore"):
                    key[is_hot] += (salts[doc[is_hot]] % wide_parts[at[is_hot]]) * np.uint64(
                        0xC2B2AE3D27D4EB4F)
            bucket = (mix(key) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            lo, hi = chunk.starts[begin], chunk.ends[end + WINDOW - 2]
            first = begin - chunk.first_word[doc]
            raw, rows, blobs = chunk.raw, [], []
            for a, b in zip(cut, np.append(cut[1:], len(order))):
                which = order[a:b]
                text = b" ".join([raw[i:j] for i, j in zip(lo[which].tolist(), hi[which].tolist())])
                docs = [chunk.keys[i] for i in doc[which].tolist()]
                body = ([k for k, _ in docs], np.array([m for _, m in docs], dtype=np.int64),
                        first[which].astype(np.int64), (end - begin)[which].astype(np.int64),
                        is_hot[which], text)
                rows.append(int(bucket[which[0]]))
                blobs.append(pack.compress(pickle.dumps(body, protocol=5)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(blobs, pa.binary())],
                names=["bucket", "body"])

    return run


def _same_as_first(windows: np.ndarray, firsts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each window's words equal those of the window it is compared with."""
    ok = np.ones(len(windows), dtype=bool)
    for k in range(WINDOW):
        ok &= hashes[windows + k] == hashes[firsts + k]
    return ok


def _groups(h: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Number of equal windows of each window: ``h`` sorts them, words decide."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    head = np.flatnonzero(np.diff(s, prepend=s[:1] + np.uint64(1)))
    sizes = np.diff(np.append(head, len(s)))
    group = np.repeat(np.arange(len(head)), sizes)
    several = sizes[group] > 1
    count = np.ones(len(h), dtype=np.int64)
    mine = order[several]
    if len(mine):
        ref = order[head[group[several]]]
        same = _same_as_first(at[mine], at[ref], hashes)
        count[mine] = sizes[group[several]]
        if not same.all():  # equal hashes of different words: count by the words themselves
            bad = np.isin(group[several], group[several][~same])
            odd = mine[bad]
            words = np.stack([hashes[at[odd] + k] for k in range(WINDOW)], axis=1)
            _, inverse, n = np.unique(words, axis=0, return_inverse=True, return_counts=True)
            count[odd] = n[inverse.ravel()]
    return count


OUT = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("first", pa.int64()),
                 ("last", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int64())])


def _settle(group: pa.Table) -> pa.Table:
    """Covered ranges of one bucket (n null), and reports of its hot windows."""
    unpack = zstandard.ZstdDecompressor()
    ids, marks, firsts, counts, hots, texts = [], [], [], [], [], []
    for body in group.column("body"):
        d, m, f, c, h, t = pickle.loads(unpack.decompress(body.as_buffer()))
        ids += d
        marks.append(m)
        firsts.append(f)
        counts.append(c)
        hots.append(h)
        texts.append(t)
    marks, firsts, counts, hots = map(np.concatenate, (marks, firsts, counts, hots))
    hash_parts = []
    for t in texts:
        buf = np.frombuffer(t, dtype=np.uint8)
        hash_parts.append(word_hashes(buf, *word_spans(buf)))
    hashes = np.concatenate(hash_parts)
    del texts, hash_parts
    # windows: run r holds words word0[r] ... and counts[r] windows
    word0 = np.cumsum(counts + WINDOW - 1) - (counts + WINDOW - 1)
    run = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = word0[run] + nth
    h1 = rolling(hashes, WINDOW)[at]
    count = _groups(h1, at, hashes)
    twice = count > 1
    # ranges of neighbouring windows found twice
    w = np.flatnonzero(twice)
    if len(w):
        new = np.ones(len(w), dtype=bool)
        new[1:] = (np.diff(w) > 1) | (run[w][1:] != run[w][:-1])
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(w)) - 1
        r = run[w[a]]
        lo, hi = firsts[r] + nth[w[a]], firsts[r] + nth[w[b]] + WINDOW
    else:
        r = lo = hi = np.empty(0, dtype=np.int64)
    # each distinct hot window once: its count here, and where it is if alone
    hot = np.flatnonzero(hots[run])
    if len(hot):
        h2 = rolling(hashes, WINDOW, 0xA0761D6478BD642F)[at[hot]]
        _, keep = np.unique(np.stack([h1[hot], h2], axis=1), axis=0, return_index=True)
        hot, h2 = hot[keep], h2[keep]
    else:
        h2 = np.empty(0, dtype=np.uint64)
    hr = run[hot]
    n1, n2 = len(r), len(hot)
    docs = [ids[i] for i in r.tolist()] + [ids[i] for i in hr.tolist()]
    no = [None] * n1
    start = firsts[hr] + nth[hot] if n2 else np.empty(0, dtype=np.int64)
    return pa.table([
        pa.array(docs, pa.int64()), pa.array(np.concatenate([marks[r], marks[hr]])),
        pa.array(np.concatenate([lo, start])), pa.array(np.concatenate([hi, start + WINDOW])),
        pa.array(no + h1[hot].view(np.int64).tolist(), pa.int64()),
        pa.array(no + h2.view(np.int64).tolist(), pa.int64()),
        pa.array(no + count[hot].tolist(), pa.int64())], schema=OUT)


def _spark_schema(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} long" for f in schema)


def _frequent(whole: DataFrame, hot: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, minimisers (ascending) that are hot if ``hot`` rank last, their parts."""
    counted = materialise(
        whole.mapInArrow(_count(hot), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        .where((F.col("n") >= HOT_AT) | F.col("key").isNull()), "minimisers")
    total = sum(r.n for r in counted.where("key IS NULL").collect())
    rows = counted.where("key IS NOT NULL").orderBy(F.desc("n"), "key").limit(HOT_LIST).collect()
    keys = np.array([r.key for r in rows], dtype=np.int64).view(np.uint64)
    parts = np.array([-(-r.n // HOT_SHARE) for r in rows], dtype=np.uint64)
    order = np.argsort(keys)
    return total, keys[order], parts[order]


def packed_windows(whole: DataFrame) -> DataFrame:
    """bucket and body: the super-k-mers of (doc_id, mark, text)."""
    total, hot, parts = _frequent(whole, np.empty(0, dtype=np.uint64))
    wide = hot
    if len(hot):
        _, wide, parts = _frequent(whole, hot)
    words = total * (2 * WINDOW + GRAM) // (WINDOW - GRAM)  # words sent, about
    buckets = max(MIN_BUCKETS, words // BUCKET_WORDS)
    return whole.mapInArrow(_spread(hot, wide, parts, buckets), "bucket long, body binary")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("mark"), text.alias("text"))


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Word ranges [first, last) to remove: doc_id, mark (hash of the text), first, last."""
    ship(docs.sparkSession)
    packed = packed_windows(keyed(docs, id_col, text_col))
    settled = materialise(packed.groupBy("bucket").applyInArrow(_settle, _spark_schema(OUT)),
                          "windows")
    alone = settled.where("n IS NOT NULL")
    seen = alone.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where("n > 1")
    across = (alone.where("n = 1").select("doc_id", "mark", "first", "last", "h1", "h2")
              .join(seen.select("h1", "h2"), ["h1", "h2"], "left_semi"))
    cols = ["doc_id", "mark", "first", "last"]
    return settled.where("n IS NULL").select(*cols).unionByName(across.select(*cols))


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [[], [], [], []]
            for text, ranges in zip(batch.column(1), batch.column(2).to_pylist()):
                raw = text.as_buffer()
                words = raw.to_pybytes().split() if raw is not None else []
                kept, at = [], 0
                for r in sorted((r["first"], r["last"]) for r in ranges or ()):
                    kept += words[at:max(at, r[0])]
                    at = max(at, r[1])
                kept += words[at:]
                joined = b" ".join(kept)
                cols[0].append(len(words))
                cols[1].append(len(words) - len(kept))
                cols[2].append(hashlib.sha256(joined).hexdigest())
                cols[3].append(joined.decode() if with_text else None)
            arrays = [batch.column(0), pa.array(cols[0], pa.int64()),
                      pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                arrays.append(pa.array(cols[3], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = True) -> DataFrame:
    """One row per document: words, words removed, digest and text of what stays."""
    ranges = (repeated_ranges(docs, id_col, text_col)
              .groupBy("doc_id", "mark")
              .agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
              .select(F.col("doc_id").alias("r_doc"), F.col("mark").alias("r_mark"), "ranges"))
    text = F.col(text_col).cast("string")
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                        F.xxhash64(text).alias("mark"))
    joined = whole.join(ranges, whole["doc_id"].eqNullSafe(ranges["r_doc"])
                        & (whole["mark"] == ranges["r_mark"]), "left")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return (joined.select("doc_id", "text", "ranges")
            .mapInArrow(_cut(with_text), schema + (", kept_text string" if with_text else "")))
