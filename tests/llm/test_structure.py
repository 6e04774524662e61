"""Operators 11 to 13 against brute force, with edge cases."""

import random
from collections import Counter

import pandas as pd
import pytest

from opticart.llm import conversation_repair as cr
from opticart.llm import merkle_manifest as mm
from opticart.llm import piecewise_hash as ph
from opticart.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.conftest import rows_of, sentence

CONV = "conv_id long, turn long, role string, text string, Nth int, at string, present string"
REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def reports(df):
    return {r.conv_id: tuple(r[c] for c in REPORT) for r in df.collect()}


def hard_rows(seed=1, n=400):
    """Conversations of few texts, odd roles, nulls, ties, repeated rows and gaps."""
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \t", None, "So be it!  \n", "a.b", "…", "x" * 50_000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "us", "Ärzte"]
    rows = []
    for c in range(n):
        for _ in range(rng.randint(1, 9)):
            rows.append((rng.choice([c, c, c, None]) if c % 40 == 0 else c,
                         rng.choice([None, *range(8), 10 ** 17 + 1]), rng.choice(roles),
                         rng.choice(texts[:-1]) if rng.random() < 0.99 else texts[-1]))
    return rows + rows[:30]


def test_conversation_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = reports(QUERIES["op11_conversation_repair"](spark, SMALL))
    assert got == {c: r[:-1] for c, r in brute.repaired(brute.damaged(rows)).items()}


def test_conversation_edges(spark):
    rows = hard_rows()
    df = spark.createDataFrame([(*r, 1, "a", "p") for r in rows], CONV)
    harmed = cr.damaged(df)
    want = brute.repaired(brute.damaged(rows))
    got = cr.repair(harmed, "present").cache()
    assert reports(got) == {c: r[:-1] for c, r in want.items()}
    assert None in want and any(r[6] == "" for r in want.values())
    turns = {}
    for r in sorted(cr.repaired_turns(harmed, got, "present").collect(), key=lambda r: r.place):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns == {c: list(r[-1]) for c, r in want.items() if r[-1]}
    got.unpersist()


def test_conversation_without_rows_is_listed(spark):
    df = spark.createDataFrame([(7, 0, "user", "Hi.", False), (8, 0, "user", "Hi.", None)],
                               "conv_id long, turn long, role string, text string, here boolean")
    empty = (0, 0, 0, 0, 0, 0, "",
             "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")
    assert reports(cr.repair(df, "here")) == {7: empty, 8: empty}


def test_giant_conversation_spills(monkeypatch):
    """Carried over batches, with back-pointers in a file, as in memory."""
    rng = random.Random(4)
    rows = [(True, i, rng.choice(["user", "assistant", "system", "bot"]),
             rng.choice(["Yes.", "No", "", "Hm"]) + str(rng.randint(0, 900)) + rng.choice([".", ""]))
            for i in range(4000)]
    want = brute._repaired(rows)
    seen, frame = set(), []
    for _, i, role, text in rows:
        frame.append(("c", i, False, role, text, True, (role, text) in seen))
        seen.add((role, text))
    columns = ["conv_id", "turn", "untimed", "role", "text", "present", "repeated"]
    for spill in (1 << 20, 7, 1000):
        monkeypatch.setattr(cr, "SPILL_AT", spill)
        parts = [pd.DataFrame(frame[i:i + 333], columns=columns) for i in range(0, 4000, 333)]
        out = pd.concat(list(cr._stream(iter(parts))))
        assert len(out) == 1 and tuple(out.iloc[0][1:]) == want[:-1]


def test_conversation_steps_are_few():
    steps, kinds = cr._Steps(), [cr.GONE] + [a + b for a in "sua?" for b in "+-"]
    todo, seen = [steps.FIRST], {steps.FIRST}
    while todo:
        position = todo.pop()
        for kind in kinds:
            after = steps.steps[steps.number(position, kind)][0]
            if after not in seen:
                seen.add(after)
                todo.append(after)
    assert len(steps.steps) < 1 << 16


def next_rows(df):
    return Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint,
                    round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect())


def brute_next(rows):
    return Counter((*r[:-2], round(r[-2], 9), round(r[-1], 9)) for r in brute.with_next(rows))


def test_fingerprint_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert next_rows(QUERIES["op12_piecewise_hash"](spark, SMALL)) == brute_next(rows)


def test_fingerprint_edges(spark, frame, edge_pairs):
    pairs = list({d: t for d, t in edge_pairs}.items())       # ids differ, one null
    assert next_rows(ph.compared_with_next(frame(pairs))) == brute_next(pairs)
    for few in (pairs[:1], pairs[:2], [(3, None)], [(3, ""), (4, None)]):
        assert next_rows(ph.compared_with_next(frame(few))) == brute_next(few)


def test_fingerprint_repeated_rows(frame):
    """Equal rows follow one another; only the last of them meets the next id."""
    pairs = [(5, "some words of a text that repeats, over and over")] * 300 + [(6, "another one")]
    got = ph.compared_with_next(frame(pairs)).collect()
    assert Counter((r.doc_id, r.near_next) for r in got) == Counter(
        {(5, 1.0): 299, (5, 0.0): 1, (6, 0.0): 1})


def test_fingerprint_blocks_and_long_texts(monkeypatch):
    rng = random.Random(2)
    texts = [sentence(rng, 30_000), "x " * 70_000, "é" * 3000, "ab", sentence(rng, 300) * 40]
    want = [brute.piecewise(t) for t in texts]
    for block in (1 << 20, 4096, 61):
        monkeypatch.setattr(ph, "BLOCK", block)
        assert [ph.fingerprint(t) for t in texts] == want


def test_fingerprint_likeness_follows_the_edit():
    rng = random.Random(6)
    for words in (40, 200, 2000, 20_000):
        one, two = sentence(rng, words), sentence(rng, words)
        half = len(one) // 2
        marks = [ph.fingerprint(t) for t in (one, one[:half] + two[:half],
                                             one + " an addition", two)]
        near = [ph.likeness(marks[0], m) for m in marks]
        assert near[0] == 1 and 0.3 < near[1] < 0.7 and near[2] > 0.85 and near[3] < 0.15
        assert near == [ph.likeness(m, marks[0]) for m in marks]


def test_fingerprint_frames(spark, frame, edge_pairs):
    got = ph.fingerprints(frame(edge_pairs))
    marks = {r.doc_id: r.fingerprint for r in got.collect() if r.doc_id in (1, 3, 10)}
    pairs = spark.createDataFrame([(marks[1], marks[3]), (marks[1], marks[10])], "a string, b string")
    near = [r.likeness for r in ph.likenesses(pairs, "a", "b").collect()]
    assert near == [brute.likeness(marks[1], marks[3]), brute.likeness(marks[1], marks[10])]


def manifest_rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_manifest_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*mm.FIELDS).collect()]
    got = manifest_rows(QUERIES["op13_merkle_manifest"](spark, SMALL))
    assert got == Counter(brute.merkle(rows))
    assert {r[-1] for r in got} == {True, False}


def odd_documents(frame_rows):
    rng = random.Random(8)
    out = []
    for i, r in enumerate(frame_rows):
        source = rng.choice([None, "", "a", "é", "z", "a"])
        out.append((r[0], r[1], rng.choice([None, "en"]), source, *r[4:]))
    for i in range(400):
        out.append((rng.choice([-5, -(1 << 62), 1 << 62, 63, 64, i, i * 70_000]), f"Text {i % 7}",
                    "en", "hot", i % 3) + out[0][5:])
    return out + out[:40]


@pytest.mark.parametrize("few", [1 << 16, 3])
def test_manifest_edges(spark, edge_pairs, monkeypatch, few):
    """Nulls, ties, repeated rows, negative and far ids; one and several directory levels."""
    from tests.llm.conftest import SCHEMA
    monkeypatch.setattr(mm, "FEW", few)
    rows = odd_documents(rows_of(edge_pairs))
    docs = spark.createDataFrame(rows, SCHEMA)
    want = Counter(brute.merkle([(r[0], r[3], r[2], r[4], r[1]) for r in rows]))
    assert manifest_rows(mm.manifest(docs, mm.by_crc())) == want


@pytest.mark.parametrize("n", [1, 2, 16, 17, 4095, 4096, 4097, 66_000])
def test_manifest_block_borders(spark, n):
    """Whole blocks, a block and one more, and a third round, next to a small source."""
    rows = [(3 * i, "big", "en", 1, "T") for i in range(n)] + [(1, "small", None, 2, None)]
    docs = spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "source", "lang", "n_chars",
                                                             "text"]))
    got = manifest_rows(mm.manifest(docs, mm.by_crc()))
    assert got == Counter(brute.merkle(rows))


def test_manifest_leaves_few_scratch_tables(spark):
    """Only what the result reads stays: the leaves' places and the paths above them."""
    import os

    from opticart.session import ensure_checkpoint_dir
    root = f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/llm"

    def tables():
        return {n for n in os.listdir(root) if not n.startswith("package")
                and any(f.endswith(".parquet") for f in os.listdir(f"{root}/{n}"))}

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    mm.manifest(docs).count()
    before = tables()
    mm.manifest(docs).count()
    assert sorted(n.rpartition("-")[0] for n in tables() - before) == ["paths", "places"]


def test_manifest_of_many_sources(spark):
    rows = [(i, f"s{i}", "en", 1, "T") for i in range(5000)]
    docs = spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "source", "lang", "n_chars",
                                                             "text"]))
    assert manifest_rows(mm.manifest(docs, mm.by_crc())) == Counter(brute.merkle(rows))
