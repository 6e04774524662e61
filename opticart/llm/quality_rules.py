"""Quality rules with thresholds learnt per language and source (native).

Every document gets integer measures. A mergeable quantile sketch per
(language, source, measure) - a histogram over log-linear integer buckets,
merged by adding counts - gives the quartiles, and from them an upper (for
the word length also a lower) fence. The fences are joined back and the
documents outside are rejected. Small groups fall back to the sketch of
their language, then to that of all documents: merging sketches is adding
their counts.

Defined cases: a null text has no words and fails the base rules; null
language or source counts as the empty string; repeated rows count each
time; an empty table gives an empty result; other columns are ignored, so
their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opticart.llm.common import fresh, let, materialise, run_hashes, words_of

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Measure:
    """A measure: ``scale * numerator div denominator`` and its fence's least width."""
    name: str
    numerator: str
    denominator: str
    scale: int
    slack: int
    lower: bool = False


# Least widths keep a fence from closing on groups whose quartiles agree
# (most documents have no symbol at all).
MEASURES = (
    Measure("word_length", "word_chars", "n_words", 100, 250, lower=True),
    Measure("symbols", "n_symbols", "n_words", 1000, 150),
    Measure("dup_lines", "n_dup_lines", "n_lines", 1000, 300),
    Measure("repeats", "n_repeat_words", "n_words", 1000, 200),
    Measure("upper", "n_upper", "word_chars", 1000, 150),
)
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
FENCE = 3          # times the distance of the quartiles
MIN_GROUP = 50     # documents a group needs for a sketch of its own
SUB_BITS = 7       # buckets keep this many leading bits: error below 1/64
SALTS = 32
MAX_BROADCAST_ROWS = 20_000  # fence rows (about 120 bytes each) that may be broadcast

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words inside a window of five that occurs at least twice in the text."""

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(pairs, lambda s: F.filter(s, lambda x, j: (
            F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))))
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(starts, zero, lambda a, p: F.struct(
            (p + WINDOW).alias("end"),
            (a["n"] + p + WINDOW - F.greatest(a["end"], p)).alias("n")), lambda a: a["n"])

    hashed = run_hashes(F.transform(words, lambda w: F.xxhash64(w)), WINDOW)
    return let(hashed, lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0))).cast("long")


def measures(text: Column) -> Column:
    """Struct of the integer counts of a text (see ``COUNTS``, and lines and capitals)."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"),
                        lambda a, w: a + F.char_length(w).cast("long")).alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"))

    def line_counts(kept: Column) -> Column:
        return F.struct(F.size(kept).cast("long").alias("n_lines"),
                        (F.size(kept) - F.size(F.array_distinct(kept))).cast("long")
                        .alias("n_dup_lines"))

    return F.struct(
        let(words_of(text), counts).alias("w"),
        let(lines, line_counts).alias("l"),
        F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(whole, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"))


def _flat(m: Column) -> dict[str, Column]:
    return {"n_words": m["w"]["n_words"], "word_chars": m["w"]["word_chars"],
            "n_symbols": m["n_symbols"], "n_dup_lines": m["l"]["n_dup_lines"],
            "n_repeat_words": m["w"]["n_repeat_words"], "n_lines": m["l"]["n_lines"],
            "n_upper": m["n_upper"]}


def _value(m: Measure) -> Column:
    return F.call_function("div", F.col(m.numerator) * m.scale,
                           F.greatest(F.col(m.denominator), F.lit(1)))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT))


def _bucket(v: Column) -> Column:
    """Lower end of the log-linear bucket of a non-negative integer."""
    shift = F.greatest(F.length(F.bin(v)) - SUB_BITS, F.lit(0))
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    return F.call_function("div", v, unit) * unit


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, group columns and counts of every document."""
    m = fresh(docs, "m")[0]
    return (docs.select(F.col(id_col).alias("doc_id"),
                        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("g_lang"),
                        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("g_source"),
                        measures(F.col(text_col)).alias(m))
            .select("doc_id", "g_lang", "g_source",
                    *[c.alias(k) for k, c in _flat(F.col(m)).items()]))


def sketches(stats: DataFrame) -> DataFrame:
    """Bucket counts per language, source and measure of the documents that pass the base."""
    values = F.explode(F.array(*[
        F.struct(F.lit(i).alias("measure"), _bucket(_value(m)).alias("bucket"))
        for i, m in enumerate(MEASURES)])).alias("v")
    return (stats.where(~base_failed()).select("g_lang", "g_source", values)
            .groupBy("g_lang", "g_source", "v.measure", "v.bucket")
            .agg(F.count(F.lit(1)).alias("n")))


def _quartiles(hist: DataFrame, by: list[str]) -> DataFrame:
    """First and third quartile (bucket of that rank) per group and measure."""
    from pyspark.sql import Window

    merged = hist.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    part = Window.partitionBy(*by, "measure")
    run = part.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.withColumn("upto", F.sum("n").over(run)).withColumn("all", F.sum("n").over(part))
    return (ranked.groupBy(*by, "measure")
            .agg(F.min(F.when(F.col("upto") * 4 >= F.col("all"), F.col("bucket"))).alias("q1"),
                 F.min(F.when(F.col("upto") * 4 >= F.col("all") * 3, F.col("bucket"))).alias("q3"),
                 F.first("all").alias("n")))


def _fences(hist: DataFrame, by: list[str], suffix: str) -> DataFrame:
    """One row per group: lo_i and hi_i of each measure."""
    width = F.lit(None)
    for i, m in enumerate(MEASURES):
        width = F.when(F.col("measure") == i, F.greatest((F.col("q3") - F.col("q1")) * FENCE,
                                                         F.lit(m.slack))).otherwise(width)
    q = _quartiles(hist, by).withColumn("width", width)
    cols = [F.max("n").alias(f"n{suffix}")]
    for i, m in enumerate(MEASURES):
        at = F.col("measure") == i
        cols.append(F.max(F.when(at, F.col("q3") + F.col("width"))).alias(f"hi{i}{suffix}"))
        if m.lower:
            cols.append(F.max(F.when(at, F.col("q1") - F.col("width"))).alias(f"lo{i}{suffix}"))
    return q.groupBy(*by).agg(*cols)


def thresholds(stats: DataFrame) -> DataFrame:
    """Fences per (language, source); a small group takes those of its language,
    a small language those of all documents."""
    hist = materialise(sketches(stats), "quality-sketch")
    names = [f"hi{i}" for i in range(len(MEASURES))] + [
        f"lo{i}" for i, m in enumerate(MEASURES) if m.lower]
    own = _fences(hist, ["g_lang", "g_source"], "")
    lang = _fences(hist, ["g_lang"], "_l")
    every = _fences(hist.withColumn("one", F.lit(1)), ["one"], "_a").drop("one")
    joined = own.join(lang, "g_lang").join(F.broadcast(every))  # `every` is one row

    def pick(name: str) -> Column:
        return (F.when(F.col("n") >= MIN_GROUP, F.col(name))
                .when(F.col("n_l") >= MIN_GROUP, F.col(f"{name}_l"))
                .otherwise(F.col(f"{name}_a")).alias(name))

    return joined.select("g_lang", "g_source", *[pick(x) for x in names])


def _inside() -> Column:
    ok = F.lit(True)
    for i, m in enumerate(MEASURES):
        ok = ok & (_value(m) <= F.col(f"hi{i}"))
        if m.lower:
            ok = ok & (_value(m) >= F.col(f"lo{i}"))
    return ok


def judged(stats: DataFrame, fences: DataFrame) -> DataFrame:
    """``stats`` with base_failed and kept.

    The fences are broadcast only when their counted rows are few; beyond
    that both sides are salted, so that a source with a third of all
    documents is spread over many tasks.
    """
    if fences.count() <= MAX_BROADCAST_ROWS:
        joined = stats.join(F.broadcast(fences), ["g_lang", "g_source"], "left")
    else:
        salted = fences.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = (stats.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
                  .join(salted, ["g_lang", "g_source", "salt"], "left"))
    failed = base_failed()
    # One expression over both sides of the join: a filter on it cannot be split
    # and pushed below the measures, which would compute them again.
    kept = F.coalesce(~failed & _inside(), F.lit(False))
    return joined.withColumn("base_failed", failed).withColumn("kept", kept)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: counts, base_failed and the verdict."""
    stats = materialise(measured(docs, id_col, text_col, lang_col, source_col), "quality-counts")
    fences = materialise(thresholds(stats), "quality-fences")
    return judged(stats, fences).select("doc_id", *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source") -> DataFrame:
    """The documents that pass, with all their columns.

    The fences come from a first pass over the counts; the second pass
    counts again instead of moving the texts through a join.
    """
    stats = materialise(measured(docs.withColumn(fresh(docs, "row_id")[0], F.lit(None).cast("long")),
                                 fresh(docs, "row_id")[0], text_col, lang_col, source_col),
                        "quality-counts")
    fences = materialise(thresholds(stats), "quality-fences")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    with_m = whole.withColumn("m", measures(F.col("doc")[text_col]))
    flat = with_m.select(
        "doc", F.xxhash64(F.col("doc")[text_col]).alias("doc_id"),
        F.coalesce(F.col("doc")[lang_col].cast("string"), F.lit("")).alias("g_lang"),
        F.coalesce(F.col("doc")[source_col].cast("string"), F.lit("")).alias("g_source"),
        *[c.alias(k) for k, c in _flat(F.col("m")).items()])
    return judged(flat, fences).where("kept").select("doc.*")
