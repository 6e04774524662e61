"""Main text of pages by wrapper induction over the pages of a host.

The skeleton of a page is its tree of block elements with runs of equal
neighbours made one. The reference of a host is its most frequent skeleton.
Each page is aligned to it by simple tree matching, so the same slot of two
pages gets one number. A text that stands in the same slot on half of a host's
different pages is template; slots whose text varies are content. Inside a
marked article (or main part) nine tenths of at least ten pages are asked for,
as pages may quote or copy each other. Of the content, what is a menu, header,
footer, sidebar, notice, advert, form or comment by element, role or name
goes, and where a page marks its article or main part, only that stays.

References and templates are broadcast while their counted rows and bytes
are small, otherwise joined by a shuffle on the host (written tables, so a
host with a third of all pages is split).

Defined cases: null html gives an empty text; null or odd urls share the
empty host; a page that is cut off is read to its end; repeated pages give
their rows each and count once for a template; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opticart.llm.common import materialise, ship
from opticart.llm.html_blocks import BODY, MAIN, align, collapse, read

# different pages a host needs for a template, and their share that must agree
MIN_PAGES, MIN_SHARE = 3, (1, 2)
MAIN_PAGES, MAIN_SHARE = 10, (9, 10)   # the same inside a marked article
MAX_BROADCAST_ROWS = 20_000
MAX_BROADCAST_BYTES = 16 << 20


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _best_level(blocks: list) -> int:
    """The innermost kind of region that holds text other than boilerplate."""
    return max((level for _, _, level, junk in blocks if not junk), default=BODY)


def content(source: str | None, reference: str | None, template: set[tuple[int, int]]) -> list[str]:
    """The blocks of main text of a page."""
    if not source:
        return []
    page = read(source)
    level = _best_level(page.blocks)
    kept = [(text, node) for text, node, at, junk in page.blocks if at >= level and not junk]
    if not template or reference is None:
        return [text for text, _ in kept]
    skeleton, place = collapse(page)
    slot = align(skeleton, reference)
    return [text for text, node in kept if (slot[place[node]], _hash(text)) not in template]


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Skeletons of the pages, counted per host."""
    for batch in batches:
        seen: Counter = Counter()
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1)):
            seen[host, collapse(read(source.as_py() or ""))[0]] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in seen], pa.string()), pa.array([s for _, s in seen], pa.string()),
             pa.array(list(seen.values()), pa.int64())], names=["host", "skeleton", "n"])


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by aligned slot, with a mark of the page's whole text."""
    for batch in batches:
        cols: tuple[list, ...] = ([], [], [], [], [])
        for host, source, reference in zip(batch.column(0).to_pylist(), batch.column(1),
                                           batch.column(2).to_pylist()):
            page = read(source.as_py() or "")
            skeleton, place = collapse(page)
            slot = align(skeleton, reference)
            mark = _hash("\n".join(b[0] for b in page.blocks))
            found = {(slot[place[node]], _hash(text), level >= MAIN)
                     for text, node, level, junk in page.blocks if not junk}
            for node, text, main in found | {(-2, 0, False)}:  # -2: the page itself
                if node != -1:
                    cols[0].append(host)
                    cols[1].append(node)
                    cols[2].append(text)
                    cols[3].append(mark)
                    cols[4].append(main)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), *(pa.array(c, pa.int64()) for c in cols[1:4]),
             pa.array(cols[4], pa.bool_())], names=["host", "slot", "text", "mark", "main"])


def _small(table: DataFrame, column: str) -> DataFrame:
    """``table`` marked for broadcast if its counted rows and bytes are small."""
    n, size = table.agg(F.count(F.lit(1)), F.sum(F.length(F.to_json(F.struct(column))))).first()
    if n <= MAX_BROADCAST_ROWS and (size or 0) <= MAX_BROADCAST_BYTES:
        return F.broadcast(table)
    return table


def _agree(least: int, share: tuple[int, int]) -> Column:
    return ((F.col("pages") >= least)
            & (F.col("n") * share[1] >= F.col("pages") * share[0]))


def wrappers(pages: DataFrame) -> DataFrame:
    """host, skeleton and template (slot and text of each constant node) of each
    host; ``pages`` has host and html."""
    counted = (pages.mapInArrow(_skeletons, "host string, skeleton string, n long")
               .groupBy("host", "skeleton").agg(F.sum("n").alias("n")))
    reference = materialise(
        counted.groupBy("host").agg(F.max(F.struct("n", "skeleton")).alias("best"))
        .select("host", "best.skeleton"), "skeletons")
    slots = (pages.join(_small(reference, "skeleton"), "host").select("host", "html", "skeleton")
             .mapInArrow(_slots, "host string, slot long, text long, mark long, main boolean")
             .distinct().groupBy("host", "slot", "text", "main").agg(F.count(F.lit(1)).alias("n"))
             .where(f"n >= {MIN_PAGES} OR slot = -2"))
    slots = materialise(slots, "slots")
    sizes = slots.where("slot = -2").select("host", F.col("n").alias("pages"))
    constant = (slots.where("slot >= 0").join(sizes, "host")
                .where(F.when(F.col("main"), _agree(MAIN_PAGES, MAIN_SHARE))
                       .otherwise(_agree(MIN_PAGES, MIN_SHARE)))
                .groupBy("host").agg(F.collect_list(F.struct("slot", "text")).alias("template")))
    return materialise(reference.join(constant, "host"), "wrappers")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, reference, template in zip(batch.column(2), batch.column(3).to_pylist(),
                                               batch.column(4).to_pylist()):
            constant = {(t["slot"], t["text"]) for t in template or ()}
            texts.append("\n".join(content(source.as_py(), reference, constant)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url, text (blocks joined by line ends) and n_chars of every page."""
    ship(pages.sparkSession)
    url = F.col(url_col).cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\w+://([^/:?#]*)", 1))
    whole = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"),
                         F.col(html_col).cast("string").alias("html"), host.alias("host"))
    learnt = wrappers(whole.select("host", "html"))
    joined = whole.join(_small(learnt, "template"), "host", "left")
    return joined.select("page_id", "url", "html", "skeleton", "template").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")
