"""Jaccard join of word 5-grams by MinHash banding and exact verification.

Despite the module's name there is no LSH forest: no sorted signatures, no
prefix tries, nothing shortened by document. Every document's signature is cut
into ``TREES`` bands of k hash values, one key each, and documents meet if a
key is equal. A pair of similarity s shares a band with probability
1 - (1 - s^k)^TREES; k is the greatest number up to ``DEPTH`` for which that
reaches ``RECALL`` at the threshold, and is fixed before any data is read.

No pairs are made from a key: its members are tied to its least member, and
the connected components of these ties are what may be similar. Each
component's texts then meet in one group (a component of more than ``GROUP``
texts in blocks, each pair of blocks in a group of its own), where an
inverted index counts the shared 5-grams of every pair exactly.

Texts with equal sets of 5-grams are one class member with a count; copies
are never expanded.

Defined cases: a text of 1 to 4 words has one gram of all its words; a null
or empty text (no words) is linked to nothing and is its own class; repeated
rows are copies; a null id stays null and never becomes a class id while
another member has one; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.llm.common import fresh, materialise, ship
from opticart.llm.components import components
from opticart.llm.wordhash import mix, rolling, word_hashes, word_spans

GRAM = 5
THRESHOLD = (4, 5)   # similarity of 0.8 as a fraction, compared in integers
TREES = 24
DEPTH = 8
RECALL = 0.999
GROUP = 1024         # texts of a component that meet in one group
MEET = 2000          # texts of small components dealt to one group, about
CHUNK = 2 << 20
MAX_BROADCAST_ROWS = 1_000_000  # document keys of 16 bytes


def depth_for(threshold: float, trees: int = TREES, recall: float = RECALL,
              depth: int = DEPTH) -> int:
    """The longest band whose matches reach the recall at the threshold."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def _gram_lists(raws: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes of the texts, one after the other, and where each text's begin."""
    buf = np.frombuffer(b"\n".join(raws), dtype=np.uint8)
    starts, ends = word_spans(buf)
    h = word_hashes(buf, starts, ends)
    last = np.cumsum([len(r) + 1 for r in raws])
    first = np.searchsorted(starts, np.concatenate([[0], last[:-1]]))
    words = np.diff(np.append(first, len(h)))
    grams = rolling(h, n)
    doc = np.repeat(np.arange(len(raws)), words)
    within = np.arange(len(h)) - np.repeat(first, words)
    whole = np.flatnonzero(within + n <= np.repeat(words, words))
    counts = np.bincount(doc[whole], minlength=len(raws))
    begin = np.cumsum(counts) - counts
    if not ((words > 0) & (words < n)).any():
        return grams[whole], np.append(begin, len(whole))
    lists = [grams[whole[b:b + c]] if c or not w else rolling(h[f:f + w], w)
             for f, w, b, c in zip(first.tolist(), words.tolist(), begin.tolist(), counts.tolist())]
    sizes = [len(x) for x in lists]
    return np.concatenate(lists), np.concatenate([[0], np.cumsum(sizes)])


def _sketch(gram: int, trees: int, depth: int):
    """mapInArrow function: doc_id, mark, fingerprint of the gram set, keys of the bands."""
    rng = np.random.default_rng(20240229)  # fixed: all tasks must agree
    factors = rng.integers(1, 1 << 32, trees * depth, dtype=np.uint32) | np.uint32(1)
    masks = rng.integers(0, 1 << 32, trees * depth, dtype=np.uint32)

    def keys_of(grams: np.ndarray, begin: np.ndarray) -> np.ndarray:
        low = (grams >> np.uint64(32)).astype(np.uint32)
        out = np.empty((len(begin), trees), dtype=np.uint64)
        for t in range(trees):
            key = np.full(len(begin), t + 1, dtype=np.uint64)
            for k in range(t * depth, (t + 1) * depth):
                x = (low ^ masks[k]) * factors[k]
                x ^= x >> np.uint32(15)
                x *= np.uint32(0x2C1B3C6D)
                key = mix(key * np.uint64(0x9E3779B97F4A7C15)
                          + np.minimum.reduceat(x, begin).astype(np.uint64))
            out[:, t] = key
        return out

    def flush(ids, marks, raws) -> pa.RecordBatch:
        grams, at = _gram_lists(raws, gram)
        some = np.flatnonzero(np.diff(at))
        keys = np.empty((0, trees), dtype=np.uint64)
        if len(some):
            keys = keys_of(grams, at[:-1][some])
        prints: list[bytes | None] = [None] * len(raws)
        rows: list[list | None] = [None] * len(raws)
        for i, row in zip(some.tolist(), keys.view(np.int64).tolist()):
            g = np.unique(grams[at[i]:at[i + 1]])
            # two sums of mixed values: the set's own, whatever the order
            prints[i] = np.array([mix(g ^ np.uint64(0x5851F42D4C957F2D)).sum(),
                                  mix(g + np.uint64(0x14057B7EF767814F)).sum()],
                                 dtype=">u8").tobytes()
            rows[i] = row
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(prints, pa.binary()),
             pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "mark", "fp", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, raws, size = [], [], [], 0
            for doc, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                       batch.column(2)):
                raw = text.as_buffer()
                ids.append(doc)
                marks.append(mark)
                raws.append(raw.to_pybytes() if raw is not None else b"")
                size += len(raws[-1])
                if size >= CHUNK:
                    yield flush(ids, marks, raws)
                    ids, marks, raws, size = [], [], [], 0
            if ids:
                yield flush(ids, marks, raws)

    return run


def _links(sets: list[np.ndarray], side: np.ndarray | None, num: int, den: int):
    """Pairs (i, j), i < j, whose similarity is at least num/den; with ``side``
    only those of two different sides. Yields (i, array of j)."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        if both * den >= num * (sizes.sum() - both) and (side is None or side[0] != side[1]):
            yield 0, np.array([1])
        return
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, ids, df = np.unique(flat, return_inverse=True, return_counts=True)
    shared = df[ids] > 1
    owner, ids = owner[shared], ids[shared]
    order = np.lexsort((owner, ids))
    posts = owner[order]
    begin = np.zeros(len(df) + 1, dtype=np.int64)
    np.cumsum(np.bincount(ids, minlength=len(df)), out=begin[1:])
    mine = np.searchsorted(owner, np.arange(len(sets) + 1))
    for i in range(len(sets) - 1):
        g = ids[mine[i]:mine[i + 1]]
        if not len(g):
            continue
        n = begin[g + 1] - begin[g]
        where = np.repeat(begin[g] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(posts[where], minlength=len(sets))[i + 1:]
        ok = both * den >= num * (sizes[i] + sizes[i + 1:] - both)
        if side is not None:
            ok &= side[i + 1:] != side[i]
        j = np.flatnonzero(ok) + i + 1
        if len(j):
            yield i, j


def _verify(gram: int, num: int, den: int):
    """applyInArrow function over the texts of some components (or of two blocks of one)."""

    def run(group: pa.Table) -> pa.Table:
        label = group.column("label").to_pylist()
        fp, copies = group.column("fp").to_pylist(), group.column("copies").to_pylist()
        block, split = group.column("block").to_pylist(), group.column("blocks").to_pylist()
        text = group.column("text")
        members: dict[bytes, dict[bytes, int]] = {}
        for row, (a, b) in enumerate(zip(label, fp)):
            members.setdefault(a, {}).setdefault(b, row)
        out: list[tuple] = []
        for rows in members.values():
            at = list(rows.values())
            grams, cut = _gram_lists([text[r].as_buffer().to_pybytes() for r in at], gram)
            sets = [np.unique(grams[a:b]) for a, b in zip(cut[:-1], cut[1:])]
            weight = np.array([copies[r] for r in at], dtype=np.int64)
            side = np.array([block[r] for r in at])
            across = split[at[0]] > 1 and side.min() != side.max()
            links = np.zeros(len(at), dtype=np.int64)
            root = np.arange(len(at))

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for i, js in _links(sets, side if across else None, num, den):
                links[i] += weight[js].sum()
                links[js] += weight[i]
                a = find(i)
                for j in np.unique(root[js]).tolist():
                    b = find(j)
                    a, b = min(a, b), max(a, b)
                    root[b] = a
            out += [(fp[r], fp[at[find(i)]], int(n), split[r])
                    for i, (r, n) in enumerate(zip(at, links.tolist()))]
        cols = list(zip(*out))
        return pa.table([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()),
                         pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                        names=["fp", "root", "links", "blocks"])

    return run


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    gram: int = GRAM, threshold: tuple[int, int] = THRESHOLD,
                    trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, mark (hash of the text), fp (its gram set, null
    if it has none), root (a key of its class, null if it has no gram), class_id (least doc_id that chains of links reach), copies
    (documents with the same gram set) and n_links (other documents at the
    similarity or above, copies included)."""
    spark = docs.sparkSession
    ship(spark)
    num, den = threshold
    depth = depth_for(num / den, trees, recall)
    text = F.col(text_col).cast("string")
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.xxhash64(text).alias("mark"), text.alias("text"))
    sketch = materialise(whole.mapInArrow(_sketch(gram, trees, depth),
                                          "doc_id long, mark long, fp binary, keys array<long>"),
                         "sketch")
    classes = materialise(sketch.where("fp IS NOT NULL").groupBy("fp").agg(
        F.min(F.struct("doc_id", "mark")).alias("rep"), F.min("doc_id").alias("first_id"),
        F.count(F.lit(1)).alias("copies")), "classes")
    nodes = materialise(sketch.select(F.explode("keys").alias("key"), "fp").distinct(), "nodes")
    least = materialise(nodes.groupBy("key").agg(F.min("fp").alias("v"),
                                                 F.count(F.lit(1)).alias("n"))
                        .where("n > 1").select("key", "v"), "nodes-least")
    ties = materialise(nodes.join(least, "key").where("fp <> v")
                       .select(F.col("fp").alias("u"), "v").distinct(), "ties")
    # A text hangs on the least of the members it is tied to; only what its
    # ties say about those members goes into the components.
    hung = materialise(ties.groupBy("u").agg(F.min("v").alias("m")), "hung")
    tops = materialise(ties.select("v").distinct(), "tops")
    joint = components(ties.join(hung, "u").where("v <> m").select("v", F.col("m").alias("u"))
                       .unionByName(hung.join(tops, hung["u"] == tops["v"], "left_semi")
                                    .select("u", F.col("m").alias("v")))
                       .distinct())
    member = hung.select(F.col("u").alias("node"), "m").unionByName(
        tops.join(hung, tops["v"] == hung["u"], "left_anti")
        .select(F.col("v").alias("node"), F.col("v").alias("m")))
    labels = materialise(
        member.join(joint.select(F.col("node").alias("m"), "label"), "m", "left")
        .select("node", F.coalesce("label", "m").alias("label")), "texts")
    sizes = materialise(labels.groupBy("label").agg(F.count(F.lit(1)).alias("size")), "sizes")
    half = GROUP // 2
    blocks = F.when(F.col("size") > GROUP, F.ceil(F.col("size") / half)).otherwise(1)
    groups = max(64, sum(r.n or 0 for r in sizes.agg(F.sum("size").alias("n")).collect()) // MEET)
    dealt = (labels.join(sizes, "label")
             .select(F.col("node").alias("fp"), "label", blocks.cast("long").alias("blocks"))
             .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
             .join(classes, "fp")
             .select("fp", "label", "blocks", "block", "copies", F.col("rep.doc_id").alias("r_doc"),
                     F.col("rep.mark").alias("r_mark")))
    # A row repeated with its id would stand for its class more than once.
    if sketch.groupBy("doc_id", "mark").count().where("count > 1").limit(1).count():
        whole = whole.dropDuplicates(["doc_id", "mark"])
    met = (whole.join(dealt, whole["doc_id"].eqNullSafe(dealt["r_doc"])
                      & (whole["mark"] == dealt["r_mark"]))
           .select("fp", "label", "blocks", "block", "copies", "text",
                   F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
           .withColumn("part", F.when(
               F.col("blocks") == 1, F.pmod(F.xxhash64("label"), F.lit(groups)).cast("string"))
               .otherwise(F.concat_ws("-", F.hex("label"), F.least("block", "other").cast("string"),
                                      F.greatest("block", "other").cast("string")))))
    found = materialise(met.groupBy("part").applyInArrow(
        _verify(gram, num, den), "fp binary, root binary, links long, blocks long"), "links")
    split = found.where("blocks > 1 AND fp <> root").select(F.col("fp").alias("u"),
                                                            F.col("root").alias("v"))
    root = found.where("blocks = 1").select("fp", "root")
    if split.limit(1).count():
        root = root.unionByName(components(split).select(F.col("node").alias("fp"),
                                                         F.col("label").alias("root")))
    counted = found.groupBy("fp").agg(F.sum("links").alias("links"))
    known = materialise(
        classes.join(root, "fp", "left").join(counted, "fp", "left")
        .select("fp", "first_id", "copies", F.coalesce("root", "fp").alias("root"),
                F.coalesce("links", F.lit(0).cast("long")).alias("links")), "known")
    ids = materialise(known.groupBy("root").agg(F.min("first_id").alias("class_id")), "class-ids")
    of_class = materialise(known.join(ids, "root").select(
        "fp", "root", "class_id", "copies", "links"), "members")
    return (sketch.select("doc_id", "mark", "fp").join(of_class, "fp", "left")
            .select("doc_id", "mark", "fp", "root",
                    F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
                    .alias("class_id"),
                    F.coalesce("copies", F.lit(1).cast("long")).alias("copies"),
                    (F.coalesce("links", F.lit(0).cast("long"))
                     + F.coalesce("copies", F.lit(1).cast("long")) - 1).alias("n_links")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class (that of least id), with all its columns.

    Documents without a word stay. Rows that repeat id and text count as one
    class's copies; one of them stays.
    """
    rows = materialise(jaccard_classes(docs, id_col, text_col).where("fp IS NOT NULL")
                       .select("doc_id", "mark", "root"), "near-rows")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    best = materialise(rows.groupBy("root").agg(F.min(order).alias("best")), "near-best")
    lost = materialise(rows.join(best, "root").where(~order.eqNullSafe(F.col("best")))
                       .select("doc_id", "mark").distinct(), "near-lost")
    if lost.count() <= MAX_BROADCAST_ROWS:
        lost = F.broadcast(lost)
    mark, r_doc, r_mark = fresh(docs, "mark", "r_doc", "r_mark")
    lost = lost.select(F.col("doc_id").alias(r_doc), F.col("mark").alias(r_mark))
    kept = (docs.withColumn(mark, F.xxhash64(F.col(text_col).cast("string")))
            .join(lost, F.col(id_col).cast("long").eqNullSafe(F.col(r_doc))
                  & (F.col(mark) == F.col(r_mark)), "left_anti"))
    if rows.groupBy("doc_id", "mark").count().where("count > 1").limit(1).count():
        empty = ~F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        kept = kept.where(~empty).dropDuplicates([id_col, mark]).unionByName(kept.where(empty))
    return kept.drop(mark)
