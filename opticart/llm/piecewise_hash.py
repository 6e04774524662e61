"""Document fingerprints by context-triggered piecewise hashing.

A hash of the last eight bytes triggers the end of a chunk, so chunk borders
depend on the text around them and come back after an insertion. At block size
2^k a border is a hash with k leading zero bits: borders at 2^(k+1) are some of
those at 2^k. The block size of a text is the least, from 4 on, that cuts it into
at most 64 chunks, for any length. The fingerprint is ``k:signature:signature``,
at 2^k and 2^(k+1), each chunk as two letters, twelve bits of the sum of the
chunk's hashes. Signatures of equal block size are compared by edit distance
(insertions and deletions of chunks), as one minus the distance over both
lengths; the better of the sizes that two fingerprints share is their likeness.

Fingerprints need no shuffle. For the comparison with the next document, the
rows are range-partitioned by id once, texts and all, and each task streams its
rows in order; the first and last row of each task go to a second, small step,
where the end of one task meets the start of the next. Only the numbers of the
tasks that have rows come to the driver.

Defined cases: a null text is empty, and an empty text has no chunk; equal
fingerprints have likeness 1, an empty one has 0 to any other; null ids come
first, rows of one id follow one another by the hash of their text, equal rows
are interchangeable and are spread over tasks; a single row is its own next one;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.llm.common import materialise, ship

MAX_CHUNKS = 64
LEAST = 2                    # block sizes start at 2^LEAST bytes
BLOCK = 1 << 20              # bytes hashed at once

_SPAN = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD1342543DE82EF95)
_LETTERS = np.frombuffer(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)

RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def _hashes(data: bytes, start: int, stop: int) -> np.ndarray:
    """Hash of the eight bytes up to each place from start to stop; ``data`` has seven before."""
    a = np.ndarray((stop - start,), "<u8", data, start, (1,)) * _MIX
    a ^= a >> np.uint64(32)
    a *= _MIX2
    return a


def _cuts(data: bytes, n: int, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the chunks at 2^level, the hashes there, and the chunks' sums."""
    limit = np.uint64(1 << (64 - level))
    ends, at_ends, sums, open_sum = [], [], [], np.zeros(1, np.uint64)
    for start in range(0, n, BLOCK):
        stop = min(start + BLOCK, n)
        h = _hashes(data, start, stop)
        cut = np.flatnonzero(h < limit)
        weights = (h ^ (h >> np.uint64(29))) * _MIX
        if cut.size:
            part = np.add.reduceat(weights, np.concatenate(([0], cut[:-1] + 1)))
            last = cut[-1] + 1
            part[-1] = weights[cut[-2] + 1 if cut.size > 1 else 0:last].sum(dtype=np.uint64)
            part[:1] += open_sum
            ends.append(cut + start)
            at_ends.append(h[cut])
            sums.append(part)
            open_sum = weights[last:].sum(dtype=np.uint64, keepdims=True)
        else:
            open_sum += weights.sum(dtype=np.uint64)
    if not ends or ends[-1][-1] != n - 1:          # the rest is a chunk, too
        ends.append(np.array([n - 1]))
        at_ends.append(np.zeros(1, np.uint64))
        sums.append(open_sum)
    return np.concatenate(ends), np.concatenate(at_ends), np.concatenate(sums)


def _letters(sums: np.ndarray) -> str:
    code = (sums * _MIX2) >> np.uint64(52)
    pairs = np.empty((len(sums), 2), np.uint8)
    pairs[:, 0] = _LETTERS[(code >> np.uint64(6)).astype(np.intp)]
    pairs[:, 1] = _LETTERS[(code & np.uint64(63)).astype(np.intp)]
    return pairs.tobytes().decode()


def _coarser(at_ends: np.ndarray, sums: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Chunks at 2^level from those at a smaller size."""
    stays = at_ends < np.uint64(1 << (64 - level))
    stays[-1] = True
    first = np.concatenate(([0], np.flatnonzero(stays)[:-1] + 1))
    return at_ends[stays], np.add.reduceat(sums, first)


def fingerprint(text: str | None) -> str:
    """``k:signature:signature`` of a text, at block sizes 2^k and 2^(k+1)."""
    raw = (text or "").encode()
    n = len(raw)
    if not n:
        return f"{LEAST}::"
    data = b"\0" * (_SPAN - 1) + raw
    # an even text has about 256 to 512 borders at this size; go down where it has few
    level = max(LEAST, (n // (8 * MAX_CHUNKS)).bit_length())
    _, at_ends, sums = _cuts(data, n, level)
    while level > LEAST and len(sums) <= MAX_CHUNKS:
        level -= 1
        _, at_ends, sums = _cuts(data, n, level)
    while len(sums) > MAX_CHUNKS:
        level += 1
        at_ends, sums = _coarser(at_ends, sums, level)
    _, twice = _coarser(at_ends, sums, level + 1)
    return f"{level}:{_letters(sums)}:{_letters(twice)}"


def _chunks(signature: str) -> list[str]:
    return [signature[i:i + 2] for i in range(0, len(signature), 2)]


def _common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a column of bits at a time."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    """One minus the edit distance of two signatures over their lengths."""
    if not a or not b:
        return float(a == b)
    a, b = _chunks(a), _chunks(b)
    return 2 * _common(a, b) / (len(a) + len(b))


def likeness(one: str, other: str) -> float:
    """Likeness of two fingerprints, 0 to 1; 0 if they share no block size."""
    if one == other:
        return 1.0
    k, a, a2 = one.split(":")
    m, b, b2 = other.split(":")
    if k == m:
        return max(_alike(a, b), _alike(a2, b2)) if a and b else 0.0
    if int(k) == int(m) + 1:
        return _alike(a, b2)
    if int(m) == int(k) + 1:
        return _alike(a2, b)
    return 0.0


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = pa.array([fingerprint(t.as_py()) for t in batch.column(batch.num_columns - 1)],
                         pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), marks], names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprints,
                                                    f"doc_id {kind}, fingerprint string")


def likenesses(pairs: DataFrame, one: str, other: str, name: str = "likeness") -> DataFrame:
    """``pairs`` with the likeness of two fingerprint columns."""
    ship(pairs.sparkSession)
    measure = F.pandas_udf(lambda a, b: a.combine(b, likeness).astype(float), "double")
    return pairs.withColumn(name, measure(one, other))


def _compared(doc_id: int | None, text: str, mark: str, after: str, after_mark: str) -> tuple:
    """Result row of a document and the text that follows it."""
    half = len(text) // 2
    edited = text[:len(text) - half] + after[:half]
    edited_mark = fingerprint(edited)
    return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), mark, edited_mark,
            likeness(mark, edited_mark), likeness(mark, after_mark))


_NAMES = [part.split()[0] for part in RESULT.split(", ")]
_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
_ROW = pa.schema([pa.field(n, _TYPES[part.split()[1]])
                  for n, part in zip(_NAMES, RESULT.split(", "))])
_MARKED = _ROW.append(pa.field("task", pa.int64())).append(pa.field("end", pa.int64())).append(
    pa.field("text", pa.string()))
FIRST, LAST = 0, 1


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in id order: results of all but the last one, and the texts at both ends."""
    task, last = TaskContext.get().partitionId(), None
    for batch in batches:
        out = []
        for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = value.as_py() or ""
            mark = fingerprint(text)
            if last is None:
                out.append((doc_id, None, None, mark, None, None, None, task, FIRST, text))
            else:
                out.append((*_compared(*last, text, mark), task, None, None))
            last = doc_id, text, mark
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*out), _MARKED)] if out else
            [pa.array([], f.type) for f in _MARKED], schema=_MARKED)
    if last is not None:
        row = (last[0], None, None, last[2], None, None, None, task, LAST, last[1])
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _MARKED)],
                                         schema=_MARKED)


def _at_border(rows: pa.Table) -> pa.Table:
    """The last row of a task and the first one of the next task."""
    ends = {r["end"]: r for r in rows.to_pylist()}
    one, two = ends[LAST], ends[FIRST]
    row = _compared(one["doc_id"], one["text"], one["fingerprint"], two["text"],
                    two["fingerprint"])
    return pa.Table.from_pylist([dict(zip(_NAMES, row))], schema=_ROW)


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and the likeness of both
    the edited text and the next document.

    The edited text has the first half of the document's characters and then as
    many as are missing from the start of the next document, by ascending id.
    """
    spark = docs.sparkSession
    ship(spark)
    # equal rows get a mark of their own, so that a group of them fills no single task
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("by_text"),
        F.monotonically_increasing_id().alias("nth"))
    order = ["doc_id", "by_text", "nth"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    done = materialise(ranged.select("doc_id", "text").mapInArrow(
        _in_order, f"{RESULT}, task long, end long, text string"), "fingerprints")
    ends = done.where(F.col("end").isNotNull())
    tasks = sorted(r.task for r in ends.where(F.col("end") == FIRST).select("task").collect())
    inside = done.where(F.col("end").isNull()).select(*_NAMES)
    if not tasks:
        return inside
    # a task's first row goes to the task before it; one row per task, so small
    before = spark.createDataFrame(list(zip(tasks, [tasks[-1], *tasks[:-1]])),
                                   "task long, before long")
    border = (ends.join(F.broadcast(before), "task")
              .withColumn("task", F.when(F.col("end") == FIRST, F.col("before"))
                          .otherwise(F.col("task")))
              .groupBy("task").applyInArrow(_at_border, RESULT))
    return inside.unionByName(border)
