"""Operators 1, 6, 7 and 8 and the pipeline."""

import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from opticart.llm import (html_blocks, html_extract, jaccard_forest, language_mix, pii, quality_rank, sql)
from opticart.llm.html_blocks import align, collapse, read
from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.test_core import check_packing

MEDIUM = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ language
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = [r for r in language_mix.identify(docs).collect() if r.held_out]
    right = sum(r.lang_pred == truth[r.doc_id] for r in rows)
    assert len(rows) > 200 and right >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_mixture_and_edges(spark, frame):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = language_mix.learn(docs)
    en, fr = (docs.where(f"lang = '{x}' AND n_chars > 1500").first().text[:1400]
              for x in ("en", "fr"))
    df = frame([(1, en), (2, en + "\n" + fr), (3, None), (4, ""), (5, "12 34 !!"), (6, "Ж"),
                (None, en), (1, en), (7, en * 200)])
    got = {r.doc_id: r for r in language_mix.predict(df, model).collect()}
    assert got[1].languages == ["en"] and got[1].score == 1.0
    assert set(got[2].languages) == {"en", "fr"} and 0.3 < got[2].score < 0.7
    assert [got[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3
    assert got[6].lang_pred in model[0] and got[7].lang_pred == got[None].lang_pred == "en"


def test_language_learns_from_the_others_only(spark, frame):
    pairs = [(i, "aaa bbb" if i % 2 else "xyz zyx") for i in range(40)]
    df = frame(pairs).selectExpr("doc_id", "text", "if(crc32(string(doc_id)) % 4 = 2, 'no', "
                                 "if(text like 'a%', 'one', 'two')) AS lang", "source")
    got = language_mix.identify(df).collect()
    assert {r.lang_pred for r in got} == {"one", "two"}
    assert all((r.lang_pred == "one") == (r.doc_id % 2 == 1) for r in got)
    nothing = frame([(1, "some words")], lang=None)
    assert [r.lang_pred for r in language_mix.identify(nothing).collect()] == ["und"]


# ------------------------------------------------------------------- quality
def test_quality_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality_rank.rank(docs, labels).collect()
    mine = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in mine) >= 0.95 * len(mine) > 30
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    turned = labels.selectExpr(
        "doc_id", "if(crc32(string(doc_id)) % 5 = 0, 1 - quality, quality) AS quality")
    assert {r.doc_id: r.score for r in quality_rank.rank(docs, turned).collect()} == {
        r.doc_id: r.score for r in rows}


def test_quality_edges(spark, frame, edge_pairs):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (None, 1), (3, None), (9, 1), (9, 1), (14, 0), (10, 1)],
        "doc_id long, quality int")
    rows = quality_rank.rank(frame(edge_pairs), labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in edge_pairs)
    assert all(0 <= r.score <= 1 for r in rows)
    one = spark.createDataFrame([(1, 1), (3, 1), (9, 1)], "doc_id long, quality int")
    assert {r.score for r in quality_rank.rank(frame(edge_pairs), one).collect()} == {1.0}


def test_quality_learns_from_every_pair(spark):
    """Weights, cut and spread are those of all labelled rows, not of some of them."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").repartition(3, "doc_id")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    featured = quality_rank.featurise(docs)
    rows = featured.join(labels.selectExpr("doc_id", "quality = 1 AS good"), "doc_id")
    got = quality_rank.fit(rows)
    data = rows.collect()
    x, good = np.array([r.x for r in data]), np.array([r.good for r in data])
    assert len(data) > 200
    assert np.allclose(got.mean, x.mean(axis=0))
    z = np.clip((x - got.mean) / got.scale, -8, 8)
    d = (z[good][:, None] - z[~good][None]).reshape(-1, x.shape[1])

    def loss(w):
        return np.logaddexp(0, -d @ w).mean() + quality_rank.RIDGE / 2 * w @ w

    w = np.zeros(x.shape[1])
    for _ in range(20):
        lose = 1 / (1 + np.exp(d @ w))
        hessian = (d * (lose * (1 - lose))[:, None]).T @ d / len(d)
        w += np.linalg.solve(hessian + quality_rank.RIDGE * np.eye(len(w)),
                             d.T @ lose / len(d) - quality_rank.RIDGE * w)
    assert loss(w) <= loss(got.weights) <= 1.01 * loss(w)
    raw = np.sort(got.raw(x))
    k = int((~good).sum())
    assert np.isclose(got.cut, (raw[k - 1] + raw[k]) / 2)
    assert np.isclose(got.slope, quality_rank.SLOPE / raw.std())


# ----------------------------------------------------------------------- pii
KEY = b"test key"


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 4321])
def test_permutation(size):
    assert sorted(pii.permute(i, size, KEY, "t") for i in range(size)) == list(range(size))


def test_pseudonyms_keep_format_and_validity():
    card = pii.redact("4111111111111111", KEY)
    assert re.fullmatch(r"\d{16}", card) and pii.luhn(card) == 0 and card != "4111111111111111"
    assert pii.redact("4111-1111 11111111", KEY).replace("-", "").replace(" ", "") == card
    assert pii.redact("4111111111111112", KEY) == "4111111111111112"  # fails its check
    iban = pii.redact("DE89370400440532013000", KEY)
    turned = iban[4:] + iban[:4]
    assert iban[:2] == "DE" and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1
    day, same = pii.redact("2001-03-14", KEY), pii.redact("14.03.2001", KEY)
    assert day.split("-") == same.split(".")[::-1] and day != "2001-03-14"
    assert pii.redact("March 14, 2001", KEY).split()[0] in pii.MONTHS
    assert pii.redact("2001-02-30 version 4.0 3.", KEY) == "2001-02-30 version 4.0 3."
    assert pii.redact("300.1.1.1 and 1.2.3.4.5", KEY) == "300.1.1.1 and 1.2.3.4.5"
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", pii.redact("+1 (017) 555-7713", KEY))
    assert re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.example\.com",
                        pii.redact("Ann.34@mail7.example.com", KEY))
    token = pii.redact('token = "dfd1944d2e84f15e89902e34b677eb5a8a7d42ab"', KEY)
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', token) and "dfd1944d" not in token
    number = pii.redact("078-05-1120", KEY)
    assert re.fullmatch(r"\d{3}-\d{2}-\d{4}", number) and number != "078-05-1120"
    assert pii.redact("078-05-1120", b"other") != number


IBANS = ["NO9386011117947", "BE68539007547034", "NL91ABNA0417164300", "AT611904300234573201",
         "LV80BANK0000435195001", "DE89370400440532013000", "ES9121000418450200051332",
         "FR1420041010050500013M02606", "PL61109010140000071219812874",
         "MT84MALT011000012345MTLCAST001S"]


@pytest.mark.parametrize("value", IBANS)
def test_ibans_before_other_words(value):
    grouped = " ".join(value[i:i + 4] for i in range(0, len(value), 4))
    for written in (value, value.lower(), grouped):
        new = pii.redact(written.replace(" ", ""), KEY)
        assert new != written.replace(" ", "")
        for after in ("", " and", " is mine", " with thanks", " 2024 or so", " 12", ".", ", then"):
            for before in ("", "No12 ", "pay to "):
                got = pii.redact(before + written + after, KEY)
                assert got.startswith(before) and got.endswith(after)
                middle = got[len(before):len(got) - len(after)]
                assert middle.replace(" ", "") == new


@pytest.mark.parametrize("before,after", [
    ("", " 12/27"), ("", " 123"), ("", " 2027 x"), ("", "-12/27"), ("No12 ", ""), ("12 ", ""),
    ("1234 ", " 99"), ("1234-", ""), ("no 7 ", " 12"), ("AB12 ", " and")])
@pytest.mark.parametrize("written", ["4111 1111 1111 1111", "4111-1111-1111-1111",
                                     "4111111111111111", "3782 822463 10005"])
def test_cards_beside_other_numbers(before, after, written):
    found = Counter()
    got = pii.redact(before + written + after, KEY, found)
    assert got == before + pii.redact(written, KEY) + after and found == {"card": 1}


def test_failed_candidates_are_tried_as_later_kinds():
    assert pii.redact("4111111111111111 4222222222222", KEY) == (
        pii.redact("4111111111111111", KEY) + " " + pii.redact("4222222222222", KEY))
    assert pii.redact("555-123-4567 1234", KEY) == pii.redact("555-123-4567", KEY) + " 1234"
    for stays in ("DE89370400440532013001 and", "10 20 30 40 50 60 70 80 90 10 11", "AB12 CDEF 3456 or",
                  "4111111111111112 12/27"):
        assert pii.redact(stays, KEY) == stays


def test_pii_tables(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.pseudonymise(docs, KEY).collect()
    values = re.compile(r"(?<!\d)\d{16}(?!\d)|\S+@\S+|token = \"\w+\"|\+1 \(\d+\) \d+-\d+", re.I)
    n = 0
    for r in rows:
        old, new = before[r.doc_id], r.text
        assert len(old) == len(new) or r.n_ip or r.n_email
        for v in values.findall(old):
            if not v.isdigit() or pii.luhn(v) == 0:
                assert v not in new
                n += 1
            else:
                assert v in new
        if not r.n_replaced:
            assert old == new
    assert n > 50


@pytest.mark.parametrize("odd", ["ab12sıcaksıcaksıcak x", "İ.smıth@ſite.example.org", "K12 ſeptember 2020",
                                 "٤111 1111 1111 1111", "GB82 WEST 1234 5698 765४ ſ", "１２/０３/２０２０"])
def test_pii_letters_that_fold_to_ascii(frame, odd):
    """They belong to no value, crash nothing and stay, next to values that go."""
    card = "4111 1111 1111 1111"
    gone = pii.redact(card, KEY)
    rows = [(1, f"{odd}, {card}."), (1, f"{odd}, {card}."), (2, None), (3, odd + " " * 9),
            (4, f"{odd}, {card}. " * 2000)]
    got = {r.doc_id: r.text for r in pii.pseudonymise(frame(rows), KEY).collect()}
    assert got[2] is None and got[1].endswith(f", {gone}.") and got[4] == (got[1] + " ") * 2000
    assert [c for c in got[3] if not c.isascii()] == [c for c in odd if not c.isascii()]


def test_pii_edges(frame, edge_pairs):
    rows = pii.pseudonymise(frame(edge_pairs)).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(edge_pairs)


# ---------------------------------------------------------------------- html
PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>x";</script></head>
<body class="with-sidebar"><header><h1>Site</h1></header><form id="f"><div class="cookie-notice">We
use cookies</div><div id="content"><article class="post"><header><h1>Title &amp; more</h1></header>
<p>One   <b>bold</b> text&nbsp;here<br>and on.<p>Two <span class="ad">BUY</span> after <a
href="x">link</a>.</p><ul><li>a<li>b</ul><div class="advert">ad</div><table><tr><td>c1<td>c2</table>
<footer>afoot</footer><section class="comments"><article>nice!</article></section></article></div>
</form><aside>side</aside><footer>f</footer></body></html>"""


def test_article_only():
    assert html_extract.content(PAGE, None, set()) == [
        "Title & more", "One bold text here and on.", "Two after link.", "a", "b", "c1", "c2"]


@pytest.mark.parametrize("source,text", [
    (None, []), ("", []), ("plain &lt;x&gt; &am", ["plain <x> &am"]), ("<p>a</p><p b='x", ["a"]),
    ("<nav>m</nav><p>b", ["b"]), ("<script>x", []), ("</p></div>c", ["c"]),
    ("<div>" * 3000 + "deep", ["deep"])])
def test_odd_pages(source, text):
    assert html_extract.content(source, None, set()) == text


@pytest.mark.parametrize("shell", [
    '<div class="site has-sidebar"><article>{}</article></div>',
    '<article class="post comments-open">{}</article>', '<main class="content with-sidebar">{}</main>',
    '<div class="elementor-widget elementor-widget-text-editor">{}</div>',
    '<div id="no-header">{}</div>', '<article>{}</article><div class="cookie-notice">c</div>',
    '<div class="left-sidebar-wrapper">s</div><div id="sidebar-left">s</div>{}',
    '<article>{}<section class="post-comments">c</section></article>'])
def test_names_that_are_not_the_elements_own(shell):
    page = shell.format('<p title="a hidden treasure">Text <math><mi>x</mi><mo>=</mo><mn>2</mn></math>'
                        '</p><object><p>in it</p></object><p hidden>gone</p>')
    assert html_extract.content(page, None, set()) == ["Text x=2", "in it"]


def test_tree_matching():
    a, _ = collapse(read("<div><p>x</p><p>y</p><ul><li>1<li>2</ul></div><table><tr><td>z</table>"))
    b, place = collapse(read("<h2>t</h2><div><p>x</p><ul><li>1</ul></div>"))
    assert a.count("li") == 1  # equal neighbours are one node
    pairs = align(b, a)
    names = a.split("\n")
    assert [names[j].split()[1] if j >= 0 else None for j in pairs] == [
        "html", None, "div", "p", "ul", "li"]


def test_long_child_lists_are_aligned_exactly():
    """One early mismatch leaves no later siblings alone."""
    run = ["1 h2 ", "1 p "] * 150
    pairs = align("\n".join(["0 html", "1 z ", *run]), "\n".join(["0 html", *run, "1 z "]))
    assert pairs == (0, -1, *range(1, 301))


@pytest.mark.parametrize("seed", range(30))
def test_halved_alignment_is_as_heavy(monkeypatch, seed):
    rng = random.Random(seed)

    def some():
        lines, depth = ["0 html"], 0
        for _ in range(rng.randint(1, 60)):
            depth = rng.randint(1, min(depth + 1, 4))
            lines.append(f"{depth} {rng.choice('abc')}")
        return "\n".join(lines)

    a, b = some(), some()
    align.cache_clear()
    want = align(a, b)
    monkeypatch.setattr(html_blocks, "MAX_GRID", 0)
    align.cache_clear()
    got = align(a, b)
    align.cache_clear()
    assert sum(j >= 0 for j in got) == sum(j >= 0 for j in want)
    matched = [j for j in got if j >= 0]
    assert matched == sorted(set(matched))
    for i, j in enumerate(got):
        assert j < 0 or a.split("\n")[i].split()[1] == b.split("\n")[j].split()[1]


def test_wrapper_removes_constant_nodes(spark):
    """Pages without an article: what all pages of the host share goes."""
    def page(i):
        return (f"<div><div>Our shop</div><ul><li>Home<li>Offers</ul><div><h2>Item {i}</h2>"
                f"<p>Text number {i} of this page.</p></div><div>All rights</div></div>")
    rows = [(i, f"https://shop.example.com/{i}", page(i)) for i in range(6)]
    rows += [(10, None, page(0)), (11, "https://one.example.com/", page(1)), (12, "x", None),
             (0, "https://shop.example.com/0", page(0))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_extract.extract(df.selectExpr("*", "1 AS host", "'t' AS skeleton")).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows)
    for i in range(6):
        assert by[i].text == f"Item {i}\nText number {i} of this page."
        assert by[i].n_chars == len(by[i].text)
    assert by[11].text.split("\n")[0] == "Our shop" and by[12].text == ""


def test_pages_give_their_documents(spark):
    """The pages of the tables hold documents: title, then the lines."""
    docs = {" ".join((r.text or "").split())
            for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = html_extract.extract(spark.read.parquet(f"{SMALL}/pages.parquet")).collect()
    assert rows and all(" ".join(" ".join(r.text.split("\n")[1:]).split()) in docs for r in rows)


# ------------------------------------------------------------------ pipeline
def test_pipeline_against_brute_force(spark, duck):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "jaccard_join", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def rows(df):
        assert df.columns == docs.columns
        return sorted((r.doc_id, r.text, r.n_chars) for r in df.collect())

    step = stages["quality_rules"](spark, docs, SMALL)
    want = duck.execute(f"WITH {sql.quality_counts('documents')} SELECT doc_id, text, n_chars "
                        "FROM judged WHERE kept ORDER BY doc_id").fetchall()
    assert rows(step) == want and 0 < len(want) < docs.count()
    step = spark.createDataFrame(step.collect(), docs.schema)
    lines = stages["line_dedup"](spark, step, SMALL)
    texts = brute.late_lines([(d, t) for d, t, _ in want])
    want = [(d, t, len(t)) for (d, _, _), t in zip(want, texts) if brute.words(t)]
    assert rows(lines) == want
    step = spark.createDataFrame(lines.collect(), docs.schema)
    near = stages["jaccard_join"](spark, step, SMALL)
    classes = brute.near_classes([(d, t) for d, t, _ in want])
    want = [x for i, x in enumerate(want) if classes[i][0] == x[0]]
    assert rows(near) == want
    step = spark.createDataFrame(near.collect(), docs.schema)
    clean = stages["decontamination"](spark, step, SMALL)
    duck.register("near_docs", step.toArrow())
    bad = {r[0] for r in duck.execute(f"WITH {sql.leak_ctes('near_docs')} SELECT doc_id "
                                      "FROM leaking").fetchall()}
    want = [x for x in want if x[0] not in bad]
    assert rows(clean) == want and bad
    from opticart.llm import packing

    step = spark.createDataFrame(clean.collect(), docs.schema)
    pieces = packing.pack(step, with_ids=True).collect()
    check_packing(pieces, [(d, t) for d, t, _ in want])
    whole = corpus_pipeline.run(spark, SMALL).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in whole} == {p.doc_id: p.doc_tokens for p in pieces}


def test_pipeline_stages_on_edges(spark, frame, edge_pairs):
    df = frame(edge_pairs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for given in (df, df.limit(0)):
            got = stage(spark, given, SMALL)
            assert got.dtypes == df.dtypes, name
            got.collect()
    assert jaccard_forest.keep_one(df.limit(0)).count() == 0
