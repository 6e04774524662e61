"""Merkle manifest of a dataset: a root over all rows, and every row's proof.

Each row is a leaf; the leaves of a source, ascending by doc_id, are reduced by
runs of 16 to the source's subroot, and the subroots, ascending by source, to the
root. A leaf's place among those of its source comes from bitmap ranks, not from
a sort: the ids of a source are a bitmap of 64-bit words, kept only where they
hold an id (``bit_or`` merges parts of a word), a directory holds the rows before
each word (sums by groups of 1024 words, by groups of those, and so on, until few
remain), and a rank is the directory's count and the bits set below the id's own.
Words in which an id repeats (or is null) are rare; their rows are numbered by one
distributed ranking.

Levels are reduced by slot arrays: the nodes of a block of 4096 places meet under
the block's key, each is put into its slot, and three levels are hashed at once.
One node per block goes on, until one is left of every tree. On the way down each
block gets the siblings on its path to the root, and its leaves fold theirs up.
No task holds more than a block; only the number of rounds is known to the driver.

Defined cases: null ids come first in their source, null sources first among
sources; rows of one id follow one another by their leaf, equal rows are
interchangeable; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opticart.functions.ranking import global_row_number
from opticart.llm.common import discard, materialise, ship

FAN = 16                      # nodes that become one node
LEVELS = 3                    # levels reduced at once
BLOCK = FAN ** LEVELS
WORD_BITS = 6                 # ids per bitmap word: 2^6
GROUP_BITS = 10               # words per directory entry of the next level: 2^10
FEW = 1 << 16                 # directory entries that one window per source may hold
NO_WORD = -(1 << 60)          # the word of a null id, before all others
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

RESULT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


def _record(values: dict[str, Column]) -> Column:
    """All fields as ``-`` for null, else byte count, colon and value."""
    parts = []
    for name in FIELDS:
        v = values[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v),
                                F.lit("-")))
    return F.concat(*parts)


def _digest(values: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(_record(values), 256))


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(tree, doc_id, leaf, other): the digest of every row and of what it was changed to.

    ``tree`` is the source with a mark before it, empty for null, so that it is never
    null and sorts as asked for. ``other`` is null for rows that were not changed:
    where ``tampered`` holds, the text's A-Z are in lower case.
    """
    plain = {c: F.col(c) for c in FIELDS}
    changed = plain | {"text": F.translate("text", string.ascii_uppercase,
                                           string.ascii_lowercase)}
    other = F.lit(None).cast("binary")
    if tampered is not None:
        other = F.when(tampered, _digest(changed))
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), _digest(plain).alias("leaf"),
        other.alias("other"))


def _before(sums: DataFrame, key: str, scratch: list[DataFrame]) -> DataFrame:
    """``sums`` (tree, key, rows, ...) with ``start`` = rows of the tree under lower keys.

    Keys are grouped by their upper bits until no tree has many groups; the starts of
    the groups come from a window per tree, those of the keys from a window per group
    of at most 1024. ``scratch`` gets the tables that the result reads.
    """
    sums = materialise(sums, "directory")
    scratch.append(sums)
    most = sums.groupBy("tree").count().agg(F.max("count")).first()[0]
    if most is None or most <= FEW:
        return sums.withColumn("start", _running("tree", key))
    upper = sums.withColumn("upper", F.shiftright(key, GROUP_BITS))
    above = _before(upper.groupBy("tree", F.col("upper").alias(key))
                    .agg(F.sum("rows").alias("rows")), key, scratch)
    above = above.select("tree", F.col(key).alias("upper"), F.col("start").alias("base"))
    return (upper.withColumn("inside", _running("tree", "upper", key))
            .join(above, ["tree", "upper"])
            .withColumn("start", F.col("base") + F.col("inside"))
            .drop("upper", "inside", "base"))


def _running(*names: str) -> Column:
    """Sum of ``rows`` of the earlier rows of a group, in the order of the last name."""
    window = Window.partitionBy(*names[:-1]).orderBy(names[-1])
    return F.coalesce(F.sum("rows").over(window.rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0))


def bitmaps(keyed: DataFrame) -> DataFrame:
    """(tree, word, bits, rows, start): the ids of each tree as bitmap words with directory."""
    bit = F.expr(f"shiftleft(1L, cast(doc_id & {(1 << WORD_BITS) - 1} AS int))")
    words = keyed.groupBy("tree", "word").agg(
        F.coalesce(F.bit_or(bit), F.lit(0)).alias("bits"), F.count(F.lit(1)).alias("rows"))
    scratch: list[DataFrame] = []
    out = materialise(_before(words, "word", scratch), "bitmaps")
    discard(*scratch)
    return out


def places(rows: DataFrame) -> DataFrame:
    """``rows`` (tree, doc_id, leaf, ...) with ``at``, the place by doc_id in the tree, from 0."""
    keyed = materialise(rows.withColumn("word", F.coalesce(F.shiftright("doc_id", WORD_BITS),
                                                           F.lit(NO_WORD))), "leaves")
    words = bitmaps(keyed)
    below = F.expr(f"~shiftleft(-1L, cast(doc_id & {(1 << WORD_BITS) - 1} AS int))")
    single = F.bit_count("bits") == F.col("rows")
    ranked = keyed.join(words, ["tree", "word"])
    placed = ranked.where(single).select(
        *rows.columns, (F.col("start") + F.bit_count(F.col("bits").bitwiseAND(below))).alias("at"))
    if words.where(~single).limit(1).count():
        tied = (ranked.where(~single).select(*rows.columns, "word", "start")
                .withColumn("nth", F.monotonically_increasing_id()))
        order = [F.col(c) for c in ("tree", "word", "doc_id", "leaf", "nth")]
        number = global_row_number(tied, order, "number")
        first = number.groupBy("tree", "word").agg(F.min("number").alias("first"))
        placed = placed.unionByName(number.join(first, ["tree", "word"]).select(
            *rows.columns, (F.col("start") + F.col("number") - F.col("first")).alias("at")))
    out = materialise(placed, "places")
    discard(keyed, words)
    return out


def _hash(joined: bytes) -> bytes:
    return sha256(joined.hex().encode()).digest()


def _levels(nodes: list[bytes], block: int) -> list[list[bytes]]:
    """A block's nodes and the levels above them, up to one node.

    Only the first block may be its tree's whole level: one node stays as it is, and
    fewer than a block are reduced as far as it takes. The others go up three levels.
    """
    levels = [nodes]
    whole = block == 0 and len(nodes) < BLOCK
    while len(levels[-1]) > 1 if whole else len(levels) <= LEVELS:
        low = levels[-1]
        levels.append([_hash(b"".join(low[i:i + FAN])) for i in range(0, len(low), FAN)])
    return levels


def _slots(table: pa.Table, column: str) -> list:
    """The values of a column, each in the slot of its place."""
    out = [None] * table.num_rows
    for at, value in zip(table.column("at").to_pylist(), table.column(column).to_pylist()):
        out[at % BLOCK] = value
    return out


NODES = "tree string, at long, node binary"
PATHS = "tree string, at long, siblings binary, shape binary, subroot binary, root binary"


def _reduce(rows: pa.Table) -> pa.Table:
    block = rows.column("block")[0].as_py()
    top = _levels(_slots(rows, "node"), block)[-1][0]
    return pa.table({"tree": [rows.column("tree")[0].as_py()], "at": [block], "node": [top]},
                    schema=pa.schema([("tree", pa.string()), ("at", pa.int64()),
                                      ("node", pa.binary())]))


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("at", (FAN - 1).bit_length() * LEVELS))


def reduce_trees(nodes: DataFrame) -> list[DataFrame]:
    """The tables (tree, at, node) of each round, from ``nodes`` to one node per tree."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("at")).first()[0] or 0) > 0:
        blocks = _blocks(rounds[-1].select("tree", "at", "node"))
        rounds.append(materialise(blocks.groupBy("tree", "block").applyInArrow(_reduce, NODES),
                                  "nodes"))
    return rounds


def _paths(nodes: list[bytes], block: int, siblings: bytes, shape: bytes) -> list[tuple]:
    """(siblings, shape) of each node of a block up to the root, given those of its top node.

    The shape has two bytes a level: the size of the run, and the node's slot in it.
    """
    levels = _levels(nodes, block)
    paths = [(siblings, shape)]
    for level in levels[-2::-1]:
        above, paths = paths, []
        for start in range(0, len(level), FAN):
            run = b"".join(level[start:start + FAN])
            size = len(run) // 32
            more, shapes = above[start // FAN]
            paths += [(run[:32 * i] + run[32 * i + 32:] + more, bytes((size, i)) + shapes)
                      for i in range(size)]
    return paths


def fold(node: bytes, siblings: bytes, shape: bytes) -> bytes:
    """The root over a node and the siblings on its path."""
    at = 0
    for size, slot in zip(shape[::2], shape[1::2]):
        cut, end = at + 32 * slot, at + 32 * (size - 1)
        node = _hash(siblings[at:cut] + node + siblings[cut:end])
        at = end
    return node


def _path_rows(rows: pa.Table, above: pa.Table) -> pa.Table:
    top = above.to_pylist()[0]
    nodes = _slots(rows, "node")
    paths = _paths(nodes, top["at"], top["siblings"], top["shape"])
    n, first = len(nodes), top["at"] * BLOCK
    return pa.table({
        "tree": [top["tree"]] * n, "at": list(range(first, first + n)),
        "siblings": [p[0] for p in paths], "shape": [p[1] for p in paths],
        "subroot": [top["subroot"]] * n, "root": [top["root"]] * n},
        schema=pa.schema([("tree", pa.string()), ("at", pa.int64()), ("siblings", pa.binary()),
                          ("shape", pa.binary()), ("subroot", pa.binary()),
                          ("root", pa.binary())]))


def _proofs(rows: pa.Table, above: pa.Table) -> pa.Table:
    top = above.to_pylist()[0]
    nodes, others, ids = (_slots(rows, c) for c in ("leaf", "other", "doc_id"))
    paths = _paths(nodes, top["at"], top["siblings"], top["shape"])
    root = top["root"]
    folded = [fold(node if other is None else other, *path)
              for node, other, path in zip(nodes, others, paths)]
    n = len(nodes)
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "leaf": [x.hex() for x in nodes],
        "subroot": [top["subroot"].hex()] * n, "root": [root.hex()] * n,
        "proof_sha256": [_hash(p[0]).hex() for p in paths],
        "folded_root": [x.hex() for x in folded], "verified": [x == root for x in folded]})


def descend(rounds: list[DataFrame], paths: DataFrame, leaf: bool = False) -> DataFrame:
    """The path of every node of the first round, given those of the trees' roots.

    With ``leaf`` the first round has leaves, and their results are returned.
    """
    lower = paths
    if len(rounds) == 1 and not leaf:
        return paths
    for i in range(max(len(rounds) - 2, 0), -1, -1):
        last = leaf and i == 0
        nodes = _blocks(rounds[i])
        lower = (nodes.groupBy("tree", "block")
                 .cogroup(paths.withColumn("block", F.col("at")).groupBy("tree", "block"))
                 .applyInArrow(_proofs if last else _path_rows, RESULT if last else PATHS))
        if not last:
            above, paths = paths, materialise(lower, "paths")
            discard(above, rounds[i + 1])
            lower = paths
    return lower


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Every row's leaf, subroot and root, the digest of its proof, and the root folded from
    the row (or what it was changed to, where ``tampered`` holds) and the siblings."""
    ship(docs.sparkSession)
    placed = places(leaves(docs, tampered))
    rounds = reduce_trees(placed.withColumn("node", F.col("leaf")))
    subroots = rounds[-1].select(F.col("tree").alias("of"), "node")
    # the tree of the subroots, by source
    numbered = global_row_number(subroots, [F.col("of")], "number")
    tops = materialise(numbered.select("of", F.lit("").alias("tree"),
                                       (F.col("number") - 1).alias("at"), "node"), "subroots")
    discard(*rounds[1:][-1:])         # the way down reads the rounds before it
    top_rounds = reduce_trees(tops.select("tree", "at", "node"))
    empty = F.lit(b"").cast("binary")
    none = F.lit(None).cast("binary")
    root = top_rounds[-1].select("tree", "at", empty.alias("siblings"), empty.alias("shape"),
                                 none.alias("subroot"), F.col("node").alias("root"))
    paths = descend(top_rounds, root)
    by_tree = (tops.select("of", "at", "node").join(paths.drop("tree", "subroot"), "at")
               .select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("at"), "siblings",
                       "shape", F.col("node").alias("subroot"), "root"))
    starts = materialise(by_tree, "paths")
    discard(tops, paths)
    return descend(rounds, starts, leaf=True)


def by_crc(divisor: int = 5) -> Column:
    """Whether the crc32 of the decimal doc_id is divisible."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor == 0
