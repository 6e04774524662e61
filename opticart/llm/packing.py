"""Harmonic packing of documents into fixed-length token sequences.

A piece of length in (C/(k+1), C/k] belongs to class k, and a bin of class
k takes exactly k pieces. Bins are filled per class and per task, so tasks
never talk to each other and nothing is shuffled. Documents may be cut: a
remainder that would leave its class's bins more than ``MAX_WASTE`` short
gives off a piece of exactly C // (k+1) tokens and goes on with the rest, so
bins end nearly full. Bins a task could not fill are joined at its end: their
pieces run on through further sequences, and the last sequence is split into
powers of two, which need no padding.

A task keeps at most k - 1 pieces of each class (below C tokens a class), no
matter how many documents it reads. Sequence ids hold the task's partition
number above a running number; a retried task gives the same ids.

Defined cases: a null or empty text is a document of the end id alone;
repeated rows are packed each; an empty table gives no piece; a null id
stays null; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.llm.common import ship

CAPACITY = 1024
MAX_WASTE = 16
END_ID = 0
SEQUENCE_BITS = 33
# Texts above this go to `tokenizers` itself: the faster library's pattern
# matcher has limits on very long runs of one character class.
PLAIN_CHARS = 1_000_000
BATCH_PIECES = 8_000

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class Encoder:
    """Ids of ``tokenizers`` for a vocabulary that also exists as ranks.

    ``byte_bpe_50k.json`` and ``byte_bpe_50k.tiktoken`` are one vocabulary
    (tests compare the ids); reading the ranks is about three times faster.
    A text that holds an added token of the JSON file (``<|endoftext|>``) gets
    that token's id there, as the default call of ``tokenizers`` gives it.
    """

    def __init__(self, name: str = "byte_bpe_50k"):
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.json_path = public_tokenizers.path(f"{name}.json")
        with open(self.json_path, encoding="utf-8") as file:
            added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens=added)
        self.slow = None

    def plain(self, text: str) -> np.ndarray:
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.json_path)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def __call__(self, text: str | None) -> np.ndarray:
        """The ids of a text and the end id."""
        if not text:
            return np.array([END_ID], dtype="<u4")
        if len(text) > PLAIN_CHARS:
            ids = self.plain(text)
        else:
            ids = np.asarray(self.fast.encode_to_numpy(text, allowed_special="all"), dtype="<u4")
        return np.append(ids, np.array([END_ID], dtype="<u4"))


@cache
def encoder(name: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(name)


@cache
def cuts(rest: int, capacity: int = CAPACITY, max_waste: int = MAX_WASTE) -> tuple:
    """(class, length) of the pieces of a remainder below the capacity."""
    out = []
    while rest:
        k = capacity // rest
        size = capacity // (k + 1)
        waste = capacity - k * rest
        if waste <= max_waste or waste <= capacity - (k + 1) * size:  # a cut would not help
            out.append((k, rest))
            break
        out.append((k + 1, size))
        rest -= size
    return tuple(out)


class Bins:
    """The bins of one task."""

    def __init__(self, first_sequence: int, capacity: int, max_waste: int):
        self.next = first_sequence
        self.capacity, self.max_waste = capacity, max_waste
        self.open: dict[int, list] = {}  # class -> pieces (doc, start, ids, doc_tokens)
        self.rows: list[tuple] = []

    def close(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), ids, total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.capacity:
            self.close([(doc, at, ids[at:at + self.capacity], total)])
            at += self.capacity
        for k, size in cuts(total - at, self.capacity, self.max_waste):
            waiting = self.open.setdefault(k, [])
            # a copy, so that a waiting piece does not hold its whole document
            waiting.append((doc, at, ids[at:at + size].copy(), total))
            at += size
            if len(waiting) == k:
                self.close(self.open.pop(k))

    def finish(self) -> None:
        """Close the bins that stayed short."""
        run: list = []
        filled = 0

        def take(pieces: list, size: int) -> tuple[list, list]:
            head, tail, room = [], [], size
            for doc, start, ids, total in pieces:
                if room:
                    head.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    tail.append((doc, start + room, ids[room:], total))
                room = max(0, room - len(ids))
            return head, tail

        for k in sorted(self.open):
            for piece in self.open[k]:
                run.append(piece)
                filled += len(piece[2])
                if filled >= self.capacity:
                    head, run = take(run, self.capacity)
                    self.close(head)
                    filled -= self.capacity
        while filled:
            size = filled
            if self.capacity - filled > self.max_waste:
                size = 1 << (filled.bit_length() - 1)
            head, run = take(run, size)
            self.close(head)
            filled -= size
        self.open = {}


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 7
    arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
              pa.array(cols[2], pa.int64()),
              pa.array([zlib.crc32(x.tobytes()) for x in cols[3]], pa.int64()),
              pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64()),
              pa.array(cols[6], pa.int64())]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    if with_ids:
        arrays.append(pa.array([x.astype(np.int32) for x in cols[3]], pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names=names)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         vocabulary: str = "byte_bpe_50k", capacity: int = CAPACITY,
         max_waste: int = MAX_WASTE, with_ids: bool = False) -> DataFrame:
    """One row per piece: where it comes from and where it stands in which sequence.

    ``with_ids`` adds the token ids of the piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(vocabulary)
        bins = Bins(TaskContext.get().partitionId() << SEQUENCE_BITS, capacity, max_waste)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                bins.add(doc, encode(text.as_py()))
                if len(bins.rows) >= BATCH_PIECES:
                    yield _batch(bins.rows, with_ids)
                    bins.rows = []
        bins.finish()
        yield _batch(bins.rows, with_ids)

    ship(docs.sparkSession)
    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
