"""Operators 2 to 5, 9 and 10 against brute force and SQL, with edge cases."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from opticart.llm import (decontaminate, jaccard_forest, line_dedup, packing, quality_rules, sql,
                          substring_dedup)
from opticart.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL
from tests.helpers import same_result
from tests.llm import brute
from tests.llm.conftest import sentence


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, duck, name):
    same_result(QUERIES[name](spark, SMALL), duck, ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, name, tmp_path):
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("hot", [(10 ** 9, 500), (2, 1)])
def test_substring_dedup(frame, edge_pairs, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_AT", hot[0])
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", hot[1])
    got = substring_dedup.remove_repeats(frame(edge_pairs)).collect()
    want = brute.without_repeats([t for _, t in edge_pairs])
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == Counter(
        (d, *w) for (d, _), w in zip(edge_pairs, want))


def test_substring_dedup_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = substring_dedup.remove_repeats(docs, with_text=False).collect()
    want = brute.without_repeats([t for _, t in rows])
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == {
        d: w for (d, _), w in zip(rows, want)}


@pytest.mark.parametrize("kind", ["copies", "repeated rows", "other texts"])
def test_hot_passage_fills_no_bucket(frame, monkeypatch, kind):
    """Neither copies of one text nor a passage in other texts go to one bucket."""
    import pickle

    import zstandard

    monkeypatch.setattr(substring_dedup, "HOT_AT", 50)
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", 10)
    rng = random.Random(3)
    passage = sentence(rng, 40)
    pairs = [(7 if kind == "repeated rows" else i,
              passage + (" " + sentence(rng, 3) if kind == "other texts" else ""))
             for i in range(800)]
    substring_dedup.ship(frame(pairs).sparkSession)
    packed = substring_dedup.packed_windows(substring_dedup.keyed(frame(pairs), "doc_id", "text"))
    rows = Counter()
    for r in packed.collect():
        body = pickle.loads(zstandard.ZstdDecompressor().decompress(r.body))
        rows[r.bucket] += len(body[0])
    assert max(rows.values()) < rows.total() / 10
    got = substring_dedup.remove_repeats(frame(pairs)).collect()
    want = brute.without_repeats([t for _, t in pairs])
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == Counter(
        (d, *w) for (d, _), w in zip(pairs, want))


def check_packing(pieces, docs):
    """Every id of every document once, gapless sequences; returns padding and tokens."""
    from tokenizers import Tokenizer

    import public_tokenizers

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    want = Counter()
    for d, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want[d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        assert len(p.ids) == p.length > 0
        by_doc[p.doc_id, p.doc_tokens].append(p)
        by_seq[p.sequence_id].append(p)
    got = Counter()
    for (d, total), ps in by_doc.items():
        starts = Counter(p.start for p in ps)
        times = starts[0]
        ps.sort(key=lambda p: (p.start, p.ids_crc32))
        if times == 1:
            ids = [x for p in ps for x in p.ids]
            assert len(ids) == total
            got[d, total, zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        else:  # repeated rows: cut alike, up to the task's last bins
            assert sum(p.length for p in ps) == times * total
            for key in want:
                if key[:2] == (d, total):
                    got[key] += times
    assert got == want
    padding = tokens = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        tokens += at
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding, tokens


def test_packing(spark, frame, edge_pairs):
    pairs = list(dict.fromkeys(edge_pairs))
    check_packing(packing.pack(frame(pairs), with_ids=True).collect(), pairs)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    padding, tokens = check_packing(packing.pack(docs, with_ids=True).collect(), rows)
    assert padding < 0.01 * tokens


@pytest.mark.parametrize("limit", [packing.PLAIN_CHARS, 5])
def test_added_tokens_keep_their_id(monkeypatch, limit):
    """The ids of the default call of ``tokenizers``, also around its added tokens."""
    from tokenizers import Tokenizer

    import public_tokenizers

    monkeypatch.setattr(packing, "PLAIN_CHARS", limit)
    default = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.Encoder()
    end = "<|endoftext|>"
    for text in (f"first doc{end}second doc", end, end * 3, f"  a \n {end}  \n b {end}", f" {end}\t",
                 f"<|endoftext{end}|> it's {end}'s", "<|endoftext|", f"x{end}1234{end}\r\n中 été"):
        ids = default.encode(text, add_special_tokens=False).ids
        assert encode(text).tolist() == ids + [packing.END_ID]
    assert len(encode(f"first doc{end}second doc")) == 6


def test_packing_repeated_rows(frame, edge_pairs):
    got = packing.pack(frame([(2, "same text"), (2, "same text")])).collect()
    assert sum(p.length for p in got) == 2 * got[0].doc_tokens


def test_cuts_fill_classes():
    for rest in range(1, packing.CAPACITY):
        pieces = packing.cuts(rest)
        assert sum(n for _, n in pieces) == rest
        for k, n in pieces:
            assert 0 <= packing.CAPACITY - k * n <= max(packing.MAX_WASTE, k)


def test_quality_rules_edges(frame, edge_pairs, duck):
    df = frame(edge_pairs)
    got = Counter(tuple(r) for r in quality_rules.quality_rules(df).collect())
    duck.register("edge_docs", df.select("doc_id", "text", "lang", "source").toArrow())
    query = sql.OP5.replace("FROM documents", "FROM edge_docs")
    want = Counter(duck.execute(query).fetchall())
    assert got == want


def test_quality_rules_salted_join(frame, edge_pairs, monkeypatch):
    want = Counter(map(tuple, quality_rules.quality_rules(frame(edge_pairs)).collect()))
    monkeypatch.setattr(quality_rules, "MAX_BROADCAST_ROWS", -1)
    assert Counter(map(tuple, quality_rules.quality_rules(frame(edge_pairs)).collect())) == want


def test_quality_thresholds_adapt(frame):
    """What is usual in one source is rejected in another."""
    plain = [(i, " ".join(f"word{i}x{k}" for k in range(60))) for i in range(80)]
    marked = [(i, " ".join(f"word{i}x{k} #" for k in range(60))) for i in range(100, 180)]
    stray = (999, marked[0][1])
    df = frame(plain + [stray], source="plain").unionAll(frame(marked, source="code"))
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(df).collect()}
    assert all(kept[i] for i, _ in plain + marked) and not kept[999]


@pytest.mark.parametrize("limit", [10 ** 6, -1])
@pytest.mark.parametrize("frame_size", [32, 1])
def test_line_dedup_edges(frame, edge_pairs, monkeypatch, limit, frame_size):
    monkeypatch.setattr(line_dedup, "MAX_BROADCAST_ROWS", limit)
    monkeypatch.setattr(line_dedup, "FRAME", frame_size)
    monkeypatch.setattr(line_dedup, "HEAVY", 3 if frame_size == 1 else 20_000)
    pairs = [p for p in edge_pairs if p[0] is not None and p != (13, edge_pairs[16][1])]
    got = line_dedup.dedup_lines(frame(pairs)).collect()
    want = brute.late_lines(pairs)
    assert Counter((r.doc_id, r.text) for r in got) == Counter(
        (d, t) for (d, _), t in zip(pairs, want))
    assert all(r.n_removed <= r.n_lines for r in got)
    line_dedup.dedup_lines(frame(edge_pairs)).collect()  # null and shared ids do not fail


@pytest.mark.parametrize("frame_size", [1024, 2])
@pytest.mark.parametrize("limit", [10 ** 6, -1])
def test_line_dedup_heavy_groups(frame, monkeypatch, frame_size, limit):
    """Similar lines that share only very frequent tokens, in groups shorter than a frame."""
    rng = random.Random(3)
    pool = [sentence(rng, 1) for _ in range(14)]
    lines = [" ".join(rng.sample(pool, rng.randint(4, 13))) for _ in range(120)]
    pairs = [(d, "\n".join(lines[d * 4:d * 4 + 4])) for d in range(30)]
    pairs[7] = (None, pairs[7][1])
    monkeypatch.setattr(line_dedup, "MAX_BROADCAST_ROWS", limit)
    monkeypatch.setattr(line_dedup, "FRAME", frame_size)
    monkeypatch.setattr(line_dedup, "HEAVY", 3)
    rng.shuffle(pairs)
    got = line_dedup.dedup_lines(frame(pairs)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(
        (d, t) for (d, _), t in zip(pairs, brute.late_lines(pairs)))


def test_line_dedup_is_native(frame, edge_pairs, monkeypatch):
    """DataFrame functions only: no Python on the executors (F1, F2 of round 3)."""
    df = frame(edge_pairs)

    def refuse(*args, **kwargs):
        raise AssertionError("Python on the executors")

    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(df), name, refuse)
    rows = line_dedup.dedup_lines(df).collect()
    assert len(rows) == len(edge_pairs)
    assert len(line_dedup.drop_lines(df).collect()) <= len(edge_pairs)


@pytest.mark.parametrize("frame_size", [32, 2])
def test_line_dedup_sizes(frame, monkeypatch, frame_size):
    """Lines of 1 to 150 words, many repeated, next to edited ones of the same or another
    class of size; separators of all kinds."""
    rng = random.Random(11)
    lines = []
    for n in [*range(1, 40), 63, 90, 107, 108, 130, 150]:
        pool = [sentence(rng, 1) for _ in range(rng.choice([2, n // 2 + 1, 3 * n]))]
        line = [rng.choice(pool) for _ in range(n)]
        lines.append(line)
        for edits in (1, n // 9 + 1, n // 5 + 1):
            other = list(line)
            for _ in range(edits):
                kind = rng.random()
                if kind < 0.4:
                    other.insert(rng.randrange(len(other) + 1), sentence(rng, 1))
                elif kind < 0.7 and len(other) > 1:
                    other.pop(rng.randrange(len(other)))
                else:
                    other[rng.randrange(len(other))] = rng.choice(pool)
            rng.shuffle(other)
            lines.append(other)
    rng.shuffle(lines)
    texts = [rng.choice([" ", "\t", "  ", "\v", "\f ", "\r"]).join(words) for words in lines]
    pairs = [(d, "\n".join(texts[d * 5:d * 5 + 5])) for d in range(len(texts) // 5 + 1)]
    monkeypatch.setattr(line_dedup, "FRAME", frame_size)
    got = line_dedup.dedup_lines(frame(pairs)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(
        (d, t) for (d, _), t in zip(pairs, brute.late_lines(pairs)))


def test_drop_lines_keeps_columns(frame, edge_pairs):
    df = frame(edge_pairs)
    got = line_dedup.drop_lines(df)
    assert got.dtypes == df.dtypes
    rows = got.collect()
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    assert {r.doc_id for r in rows} >= {None, 4, 5, 6, 10}  # null ids come first


@pytest.mark.parametrize("group", [1024, 2])
def test_jaccard_edges(frame, edge_pairs, monkeypatch, group):
    monkeypatch.setattr(jaccard_forest, "GROUP", group)
    got = jaccard_forest.jaccard_classes(frame(edge_pairs)).collect()
    want = brute.near_classes(edge_pairs)
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == Counter(
        (d, want[i][0], want[i][1]) for i, (d, _) in enumerate(edge_pairs))


@pytest.mark.parametrize("group", [1024, 3])
def test_jaccard_tables(spark, monkeypatch, group):
    monkeypatch.setattr(jaccard_forest, "GROUP", group)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = jaccard_forest.jaccard_classes(docs).collect()
    want = brute.near_classes(rows)
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == {
        d: want[i][:2] for i, (d, _) in enumerate(rows)}


def test_keep_one(frame, edge_pairs):
    df = frame(edge_pairs)
    got = jaccard_forest.keep_one(df)
    assert got.dtypes == df.dtypes
    want = brute.near_classes(edge_pairs)
    classes = {want[i][2] for i, (_, t) in enumerate(edge_pairs) if brute.words(t)}
    empty = [t for _, t in edge_pairs if not brute.words(t)]
    rows = got.collect()
    assert len(rows) == len(classes) + len(empty)
    assert len({want[edge_pairs.index((r.doc_id, r.text))][2] for r in rows
                if brute.words(r.text)}) == len(classes)


def test_forest_depth():
    k = jaccard_forest.depth_for(0.8)
    assert 1 - (1 - 0.8 ** k) ** jaccard_forest.TREES >= jaccard_forest.RECALL
    assert 1 - (1 - 0.8 ** (k + 1)) ** jaccard_forest.TREES < jaccard_forest.RECALL


ITEM = ("Alice buys 12 apples and gives Bob 5 of them. How many apples does Alice have after she "
        "walks 3 miles home and eats 2 apples?")


# every window holds the name, so a name that changes each time contradicts most of them
SUMS = ("Tom had one apple more than Tom had pears then Tom ate half of all that Tom kept "
        "for the way back when Tom went home")


def test_decontamination_slots(spark, frame):
    bench = spark.createDataFrame([(7, ITEM), (8, None), (9, "too short"), (7, ITEM), (10, SUMS),
                                   (12, "FIVE CAPITAL WORDS ALONE HERE")],
                                  "item_id long, text string")
    changed = ITEM.replace("Alice", "Karl").replace("Bob", "Dana").replace("12", "40").replace(
        "miles", "kilometers")
    mixed = ITEM.replace("Alice", "Karl", 1).replace("12", "40")  # Alice is two persons now
    scrambled = SUMS.replace("Tom", "{}").format("Ann", "Bea", "Cem", "Dan", "Eva")
    docs = frame([(1, "Before. " + ITEM + " After."), (2, changed), (3, mixed), (4, None), (5, ""),
                  (6, ITEM.split(" How")[0][:20]), (1, "Before. " + ITEM + " After."),
                  (None, changed), (11, "some other text that has nothing of the question in it"),
                  (12, scrambled), (13, SUMS.replace("Tom", "Ann")), (14, ITEM.lower()),
                  (15, "x " + " ".join(ITEM.split()[:13]) + " y"),
                  (16, "x " + " ".join(ITEM.split()[:12]) + " y"),
                  (17, "here: five capital words alone here."), (18, "word " * 9000 + ITEM)])
    got = {(r.doc_id, r.item_id): (r.exact, r.verbatim, r.n_found > 0)
           for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {
        (1, 7): (True, True, True), (2, 7): (False, False, True), (None, 7): (False, False, True),
        (3, 7): (False, True, True), (13, 10): (False, False, True), (14, 7): (True, True, False),
        (15, 7): (True, True, False), (17, 12): (True, True, False), (18, 7): (True, True, True)}


@pytest.mark.parametrize("limit", [10 ** 6, -1])
def test_decontamination_recall(spark, frame, monkeypatch, limit):
    """Shares of an item, other case and one changed word, wherever 13 words stay."""
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_ROWS", limit)
    items = [(r.item_id, r.text.split()) for r in
             spark.read.parquet(f"{SMALL}/benchmark.parquet").collect() if r.text]
    items = [(i, w) for i, w in items if len(w) >= 13]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    rng = random.Random(4)
    docs, wanted = [], set()
    for i, w in items:
        middle = len(w) // 2
        for kind, part in enumerate([w[:len(w) * s // 100] for s in (40, 60, 80, 100)]
                                    + [[x.lower() for x in w], w[:middle] + ["qqq"] + w[middle + 1:]]):
            doc = 10 * i + kind
            docs.append((doc, f"{sentence(rng, 20)} {' '.join(part)} {sentence(rng, 20)}"))
            if (len(part) >= 13 and kind != 5) or max(middle, len(w) - middle - 1) >= 13 and kind == 5:
                wanted.add((doc, i))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(docs), bench).collect()}
    assert len(wanted) > 3 * len(items) and wanted <= got


@pytest.mark.parametrize("limit", [10 ** 6, -1])
def test_drop_leaking(spark, frame, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_ROWS", limit)
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    df = frame([(1, ITEM), (2, "clean words only in this text"), (None, None), (None, ITEM)])
    got = decontaminate.drop_leaking(df, bench)
    assert got.dtypes == df.dtypes
    assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 2]
