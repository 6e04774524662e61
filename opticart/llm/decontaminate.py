"""Benchmark decontamination on question templates (native).

Texts become template words: punctuation goes; a word that starts with a
digit is a number, one that starts with a capital a name, and a unit of
measure a unit. These slots are replaced by a placeholder of their type.
Windows of ``WINDOW`` template words of the benchmark that keep at least
``MIN_LITERAL`` ordinary words are hash-joined with those of the documents.
Matches on one diagonal (same distance between item and document position)
are one occurrence. In it each slot value of the item stands for the document
value most often opposite it (the item's own value, then the least, where
several are as frequent); a window with another value opposite contradicts and
does not count, unless all its slots are the item's own. So a question with
other numbers and names is found, a text that merely has words of a template
in it is not, and one contradiction costs its own windows only. A document
leaks an item if the windows that count cover at least half of the item's.

It also leaks an item of which it holds a verbatim run of ``RUN`` words (the
whole item if that is shorter), whatever the case of the letters: runs of
untyped words in lower case are hash-joined as well, so neither a small share
of a long item nor a change of case hides it.

The benchmark's windows and runs are broadcast if their counted number allows
it (``MAX_BROADCAST_ROWS``), otherwise both sides are shuffled on the hash.

Defined cases: null texts have no windows; an item with fewer than
``WINDOW`` words is never found, one without a window of enough ordinary words
only verbatim; repeated documents are each reported under their id once; repeated
items count once; empty tables give an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opticart.llm.common import SPACE_CLASS, fresh, let, materialise, null_safe, run_hashes

WINDOW = 5
MIN_LITERAL = 3
MIN_SHARE = (1, 2)
RUN = 13                        # words of a verbatim run
MAX_BROADCAST_ROWS = 1_000_000  # windows of 24 bytes, or document keys of 16

# Units of measure that become a placeholder (fixed list).
UNITS = ("km", "cm", "mm", "kg", "mg", "lb", "lbs", "oz", "ml", "mph", "min", "mins", "hr", "hrs",
         "hour", "hours", "minute", "minutes", "second", "seconds", "day", "days", "week", "weeks",
         "month", "months", "year", "years", "dollar", "dollars", "cent", "cents", "euro", "euros",
         "pound", "pounds", "mile", "miles", "foot", "feet", "inch", "inches", "yard", "yards",
         "meter", "meters", "metre", "metres", "liter", "liters", "litre", "litres", "gram",
         "grams", "kilogram", "kilograms", "kilometer", "kilometers", "kilometre", "kilometres",
         "degree", "degrees", "percent", "gallon", "gallons")
NUMBER, NAME, UNIT = "#", "^", "~"
START = r"(?<![^\x20\x09-\x0D])"


def _bare(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}\x20\x09-\x0D]+", "")


def template_words(text: Column) -> Column:
    """Words without punctuation; a slot's word carries its type's sign in front."""
    bare = _bare(text)
    named = F.regexp_replace(bare, START + r"(\p{Lu})", "\\^$1")
    typed = F.regexp_replace(named, START + r"(\p{N})", "#$1")
    return F.array_remove(F.split(typed, SPACE_CLASS), "")


def _token(word: Column) -> Column:
    """What a word counts as in a window."""
    return (F.when(word.startswith(NAME), F.lit(NAME)).when(word.startswith(NUMBER), F.lit(NUMBER))
            .when(word.isin(*UNITS), F.lit(UNIT)).otherwise(word))


def _is_slot(word: Column) -> Column:
    return word.startswith(NAME) | word.startswith(NUMBER) | word.isin(*UNITS)


def _hashes(words: Column) -> Column:
    """Hash of each window of template words, by position."""
    return run_hashes(F.transform(words, lambda w: F.xxhash64(_token(w))), WINDOW)


def _run_hashes(text: Column, lengths: list[int]) -> Column:
    """Hashes of all runs of the given numbers (``WINDOW`` to ``RUN``) of lower-case words.

    A run is known by three windows that cover it, so that its words are hashed once
    for all lengths.
    """
    words = F.array_remove(F.split(F.lower(_bare(text)), SPACE_CLASS), "")
    hashed = run_hashes(F.transform(words, lambda w: F.xxhash64(w)), WINDOW)

    def runs(h: Column) -> Column:
        each = []
        for n in lengths:
            last = n - WINDOW
            count = F.greatest(F.size(h) - last, F.lit(0))
            each.append(F.transform(
                F.slice(h, F.lit(1), count),
                lambda first, i: F.xxhash64(
                    F.lit(n), first, F.get(h, i + min(WINDOW - 1, last)), F.get(h, i + last))))
        return F.concat(*each)

    return let(hashed, runs)


def verbatim(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, mark, item_id and imark where the document holds a verbatim run of the item."""
    size, kept = fresh(benchmark, "size", "kept")
    items = (benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias(kept),
                              F.xxhash64(F.col(item_text_col)).alias("imark")).distinct()
             .withColumn(size, F.size(F.array_remove(F.split(_bare(F.col(kept)), SPACE_CLASS), "")))
             .where(F.col(size) >= WINDOW).withColumn(size, F.least(F.col(size), F.lit(RUN))))
    lengths = sorted(r[0] for r in items.select(size).distinct().collect())  # at most 9
    of_item = None
    for n in lengths:
        hashes = items.where(F.col(size) == n).select(
            "item_id", "imark", F.explode(_run_hashes(F.col(kept), [n])).alias("hash"))
        of_item = hashes if of_item is None else of_item.unionAll(hashes)
    whole = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("mark"),
                        F.col(text_col).alias("text"))
    if of_item is None:
        return whole.limit(0).crossJoin(items.limit(0)).select("doc_id", "mark", "item_id", "imark")
    keys = materialise(of_item.distinct(), "bench-runs")
    if keys.count() <= MAX_BROADCAST_ROWS:
        keys = F.broadcast(keys)
    seen = whole.select("doc_id", "mark", F.explode(_run_hashes(F.col("text"), lengths)).alias("hash"))
    return seen.join(keys, "hash").drop("hash").distinct()


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """item_id, imark (hash of the item's text), ipos, hash, iwords and n_windows."""
    words = fresh(benchmark, "words")[0]
    items = (benchmark.select(F.col(item_col).alias("item_id"),
                              F.xxhash64(F.col(text_col)).alias("imark"),
                              template_words(F.col(text_col)).alias(words)).distinct())
    n = F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))
    windows = F.arrays_zip(
        _hashes(F.col(words)).alias("hash"),
        let(F.col(words), lambda ws: F.transform(
            F.slice(ws, F.lit(1), n), lambda _, i: F.slice(ws, i + 1, F.lit(WINDOW)))).alias("iwords"))
    each = items.select("item_id", "imark", F.posexplode(windows).alias("ipos", "w")).select(
        "item_id", "imark", "ipos", "w.hash", "w.iwords")
    literal = F.size(F.filter("iwords", lambda w: ~_is_slot(w)))
    good = each.where(literal >= MIN_LITERAL)
    counts = good.groupBy("item_id", "imark").agg(F.count(F.lit(1)).alias("n_windows"))
    return null_safe(good, counts, ["item_id", "imark"])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, mark (hash of the text), item_id, n_windows, n_found (windows that count where
    they are half of the item's or more, else 0), exact (no slot differs) and verbatim (the
    document holds a verbatim run of the item)."""
    bench = materialise(benchmark_windows(benchmark, item_col, item_text_col), "bench-windows")
    n = bench.count()
    keys = bench.select("hash", "item_id", "imark", "ipos", "n_windows")
    whole = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("mark"),
                        template_words(F.col(text_col)).alias("words"))
    seen = whole.select("doc_id", "mark", F.posexplode(_hashes(F.col("words"))).alias("pos", "hash"))
    hits = materialise(seen.join(F.broadcast(keys) if n <= MAX_BROADCAST_ROWS else keys, "hash")
                       .drop("hash").distinct(), "bench-hits")
    pair = ["doc_id", "mark", "item_id", "imark", "n_windows"]
    enough = F.col("n") * MIN_SHARE[1] >= F.col("n_windows") * MIN_SHARE[0]
    likely = materialise(hits.select(*pair, "ipos").distinct().groupBy(*pair)
                         .agg(F.count(F.lit(1)).alias("n")).where(enough).drop("n"), "bench-likely")
    who = materialise(likely.select("doc_id", "mark").distinct(), "bench-docs")
    if who.count() <= MAX_BROADCAST_ROWS:
        who = F.broadcast(who)
    text = null_safe(whole, who, ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"])
    found = null_safe(hits, likely, pair, "left_semi")
    slots = F.filter(F.transform(F.arrays_zip("iwords", "dwords"), lambda p, k: F.struct(
        (F.col("ipos") + k).alias("at"), p["iwords"].alias("i"), p["dwords"].alias("d"))),
        lambda p: _is_slot(p["i"]))
    opposite = (
        null_safe(found, bench.select("item_id", "imark", "ipos", "iwords"),
                   ["item_id", "imark", "ipos"])
        .select(*pair, "ipos", "pos", "iwords"))
    opposite = materialise(
        null_safe(opposite, text, ["doc_id", "mark"])
        .select(*pair, "ipos", (F.col("pos") - F.col("ipos")).alias("diagonal"), "iwords",
                F.slice("words", F.col("pos") + 1, F.lit(WINDOW)).alias("dwords"))
        .select(*pair, "ipos", "diagonal", slots.alias("slots")), "bench-slots")
    run = [*pair, "diagonal"]
    each = opposite.select(*run, "ipos", F.explode("slots").alias("s")).select(*run, "ipos", "s.*")
    votes = each.select(*run, "at", "i", "d").distinct().groupBy(*run, "i", "d").agg(
        F.count(F.lit(1)).alias("n"))
    stands_for = votes.groupBy(*run, "i").agg(F.min(F.struct(
        (-F.col("n")).alias("n"), (F.col("i") != F.col("d")).alias("other"), "d"))["d"].alias("most"))
    judged = (null_safe(each, stands_for, [*run, "i"]).groupBy(*run, "ipos")
              .agg(F.min(F.col("d") == F.col("most")).alias("agrees"),
                   F.min(F.col("d") == F.col("i")).alias("same"))
              .where("agrees OR same").select(*pair, "ipos", "same"))
    counted = judged.unionByName(opposite.where(F.size("slots") == 0)
                                 .select(*pair, "ipos", F.lit(True).alias("same")))
    half = (counted.groupBy(*pair, "ipos").agg(F.max("same").alias("same"))
            .groupBy(*pair).agg(F.count(F.lit(1)).alias("n"), F.min("same").alias("exact"))
            .where(enough))
    key = ["doc_id", "mark", "item_id"]
    runs = null_safe(verbatim(docs, benchmark, id_col, text_col, item_col, item_text_col),
                     bench.select("item_id", "imark", "n_windows").distinct(),
                     ["item_id", "imark"], "left")
    both = half.select(*key, "n_windows", F.col("n").alias("n_found"), "exact",
                       F.lit(False).alias("verbatim")).unionByName(
        runs.select(*key, F.coalesce("n_windows", F.lit(0).cast("long")).alias("n_windows"),
                    F.lit(0).cast("long").alias("n_found"), F.lit(None).cast("boolean").alias("exact"),
                    F.lit(True).alias("verbatim")))
    return both.groupBy(*key).agg(
        F.max("n_windows").alias("n_windows"), F.max("n_found").alias("n_found"),
        F.coalesce(F.max("exact"), F.lit(True)).alias("exact"), F.max("verbatim").alias("verbatim"))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """The documents that leak no item, with all their columns."""
    bad = materialise(leaks(docs, benchmark, id_col, text_col).select("doc_id", "mark").distinct(),
                      "leaking")
    if bad.count() <= MAX_BROADCAST_ROWS:
        bad = F.broadcast(bad)
    mark, doc, d_mark = fresh(docs, "mark", "r_doc", "r_mark")
    marked = docs.withColumn(mark, F.xxhash64(F.col(text_col)))
    bad = bad.select(F.col("doc_id").alias(doc), F.col("mark").alias(d_mark))
    return marked.join(bad, F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(mark) == F.col(d_mark)),
                       "left_anti").drop(mark)
