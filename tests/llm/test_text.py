"""Fingerprints, extraction, toxicity, language and personal data: brute force, held-out accuracy, odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayweave.llm import boosting, html_extract, imatch, langid, pii, queries, toxicity

from . import odd

SF = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# --- I-Match ---------------------------------------------------------------------------


def test_lexicon_counts_every_row(spark):
    rows = [(f"common {'half' if i % 2 else 'other'} rare{i % 25} Unique{i}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "text string, terms int")
    found, n = imatch.lexicon(df, low=0.03, high=0.6)
    terms = {w for t, _ in rows for w in t.lower().split()}
    share = {w: sum(w in t.lower().split() for t, _ in rows) for w in terms}
    band = [w for w in terms if 3 <= share[w] <= 60]
    hashed = imatch._terms(band)[1]
    assert n == 100 and sorted(found.tolist()) == sorted(hashed.tolist()) and len(found) == len(band)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_edited_texts_follow_the_rule(spark, ranges):
    rows = [r for r in odd.rows() if r[0] != 8]  # ties are tested below
    rows.append((8, "some text", "en", "a", 9, *rows[0][5:]))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=False)
    # descending ids, NULL last; rows that share an id by their texts
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for i, r in enumerate(order):
        t, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        want.append((r[0] if r[0] is not None else -1, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    got = imatch.edited_likeness(odd.docs(spark, rows), low=0.0, high=1.0, ranges=ranges).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_edge_tables_of_fingerprints(spark):
    assert imatch.edited_likeness(odd.empty(spark)).count() == 0
    one = imatch.edited_likeness(odd.docs(spark, odd.rows()[:1])).first()
    assert one.near_next == 1.0 and one.n_chars == len(odd.rows()[0][1])
    prints = {}
    for r, (i, t, *_) in zip(sorted(imatch.fingerprint(odd.docs(spark)).collect(), key=str), sorted(odd.rows(), key=str)):
        prints.setdefault(t or "", set()).add(r.fingerprint)
    by_text = imatch.fingerprint(odd.docs(spark)).join(odd.docs(spark).select("doc_id", "text"), "doc_id")
    assert by_text.where("doc_id in (1, 2)").select("fingerprint").distinct().count() == 1


def test_likeness_tells_edited_from_unrelated(spark):
    got = queries.op3_imatch(spark, SF).toPandas()
    long = got[got.n_chars > 500]
    assert len(got) == 1000 and long.near_edited.mean() > 0.25 and got.near_next.mean() < 0.02
    assert (long.near_edited > long.near_next).mean() > 0.95


def test_likeness_of_a_text_that_a_third_of_the_rows_repeat(spark):
    rng = random.Random(3)
    rare = [f"rare{i}" for i in range(3000)]
    group = " ".join(f"shared{i}" for i in range(120))
    rows = []
    for i in range(50):  # by descending id: copy, near copy, copy, other, other
        others = [" ".join(rng.choice(rare) for _ in range(120)) for _ in range(2)]
        near = group.replace("shared7 ", rng.choice(rare) + " ")
        rows += [(10 * i + k, t) for k, t in zip((5, 4, 3, 2, 1), (group, near, group, *others))]
    got = imatch.edited_likeness(spark.createDataFrame(rows, "doc_id bigint, text string")).toPandas()
    place = got.doc_id % 10
    assert got[place.isin([5, 4])].near_next.min() > 0.7  # copy and near copy, either way
    assert got[place == 3].near_edited.mean() > 0.1 and got[place == 3].near_next.max() < 0.1
    assert got[place == 2].near_next.max() < 0.2


def mixed(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB % 2**64
    return x ^ (x >> 31)


def plain_signature(hashes, lexicon):
    """Signature, parts and share of one text from the hashes of its distinct terms, by the definition."""
    inside = hashes & lexicon

    def digest(some):
        return mixed(sum(map(mixed, some)) % 2**64) if some else 0

    parts = {}
    for subset in range(imatch.SUBSETS):
        u = {h: mixed((h + mixed(subset + 1)) % 2**64) for h in hashes}
        for kind, pool in enumerate((inside, hashes)):
            for scale in range(imatch.SCALES):
                member = [u[h] for h in pool if all(u[h] >> 2 * s & 3 == 0 for s in range(scale + 1))]
                d = digest(member)
                parts[kind, scale, subset] = d % 65535 + 1 if d else 0
    return digest(inside or hashes), parts, len(inside) * 65535 // max(len(hashes), 1)


def plain_likeness(a, b):
    def agreement(kind):
        cells = [[(a[1][kind, s, k], b[1][kind, s, k]) for k in range(imatch.SUBSETS)] for s in range(imatch.SCALES)]
        filled = [[p for p in row if any(p)] for row in cells]
        use = [0 < len(f) / imatch.SUBSETS <= 0.8 for f in filled]
        if not any(use):
            use[-1] = True
        seen = [p for f, u in zip(filled, use) if u for p in f]
        return sum(x == y for x, y in seen) / len(seen) if seen else float(a[0] == b[0])

    band, every = max(agreement(0), float(a[0] == b[0])), agreement(1)
    weight = min(min(a[2], b[2]) / (65535 * imatch.ENOUGH), 1.0)
    return every + weight * (band - every) if weight < 1 else band


def test_signatures_and_likeness_equal_a_plain_version():
    rng = random.Random(8)
    words = [f"Term{i}" for i in range(60)]
    texts = ["", None, "x", "the same words", "words the same the"]
    texts += [" ".join(rng.choices(words, k=rng.choice([1, 3, 20, 90]))) for _ in range(25)]
    of, h = imatch._terms(texts)
    terms = [set(h[of == i].tolist()) for i in range(len(texts))]
    known = {w: int(imatch._terms([w])[1][0]) for w in words}
    lexicon = np.sort(np.array([known[w] for w in words[:20]], np.uint64))
    whole, parts, share = imatch.signatures(texts, lexicon)
    plain = [plain_signature(t, set(lexicon.tolist())) for t in terms]
    for i, (w, p, s) in enumerate(plain):
        assert whole[i] == w and share[i] == s
        assert {(k, a, b): int(parts[i, k, a, b]) for k, a, b in p} == p
    a, b = np.array([(i, j) for i in range(len(texts)) for j in range(len(texts))]).T
    got = imatch.likeness(tuple(x[a] for x in (whole, parts, share)), tuple(x[b] for x in (whole, parts, share)))
    assert np.allclose(got, [plain_likeness(plain[i], plain[j]) for i, j in zip(a, b)])


# --- HTML ------------------------------------------------------------------------------

PAGE = (
    '<!doctype html><html><head><title>Site &amp; title</title><style>p{}</style><script>var a="</p><article>";</script></head>'
    '<body><header><a href="/">Home</a></header><nav><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul></nav>'
    "<!-- <p>hidden words here</p> --><article><header><h1>The  headline</h1></header><p>First&nbsp;words &lt;here&gt; and\n some "
    "<i>in</i>line text, <br>after a break.<p>Second paragraph &#233;t&eacute; <a href=z>with a link</a>.</p>"
    '<div class="ad banner">Buy this now</div><form><label>Mail</label><input></form></article>'
    '<section id="comments"><p>I liked this a lot, thank you so much.</p></section><footer>&copy; 2024 All rights</footer></body></html>'
)
TEXT = "The headline First words <here> and some inline text, after a break. Second paragraph été with a link."


@pytest.fixture(scope="module")
def weights(spark):
    return html_extract.fit(table(spark, "pages"))


def test_extraction_of_a_page(weights):
    assert html_extract.extract(PAGE, weights) == TEXT
    bare = PAGE.replace("<article>", '<div class="text">').replace("</article>", "</div>").replace("<header><h1>", "<h1>").replace("</h1></header>", "</h1>")
    assert html_extract.extract(bare, weights) == TEXT
    assert html_extract.extract(bare, html_extract.PLAIN).endswith("with a link.") and "liked" not in html_extract.extract(bare, weights)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("<p></p><br>", ""),
        ("just words", "just words"),
        ("<p>never closed <b>bold <i>italic", "never closed bold italic"),
        ("<script>a<b</script", ""),
        ("<p>a < b and c > d</p>", "a < b and c > d"),
        ("<p title='x > y'>text here</p>", "text here"),
        ("<p title=don't>it's here</p>", "it's here"),
        ('<p title="never closed>text', "text"),
        ("<article><p>" + "w " * 50_000 + "</p></article>", ("w " * 50_000).strip()),
        ("<div>" * 5000 + "deep words" + "</div>" * 5000, "deep words"),
    ],
)
def test_extraction_of_odd_pages(weights, page, want):
    got = html_extract.extract(page, weights)
    assert got == want or (page or "").startswith("<div><div>") and got == ""


STORY = "<p>This is the story of the page, and it has many words in it.</p><p>It goes on with a second paragraph of words.</p>"
STORY_TEXT = "This is the story of the page, and it has many words in it. It goes on with a second paragraph of words."


@pytest.mark.parametrize(
    "page",
    [
        '<body class="no-sidebar"><nav><a href=x>One</a></nav>{}</body>',
        '<html class="no-comments"><head><body>{}</body></html>',
        '<body><main class="with-sidebar">{}</main></body>',
        '<body><article class="social share">{}</article></body>',
        '<body><div id="search-results">{}</div></body>',
        '<body><div id="search-results"><article>{}</article></div></body>',
        '<body><form action="/x"><input>{}</form></body>',
        '<body><form action="/x"><div class="widget"><main>{}</main></div><footer>All rights reserved</footer></form></body>',
        '<body><aside><article>{}</article></aside></body>',
        '<body><article>{}</article><div class="related"><p>Read some more of this.</p></div></body>',
        '<body><div>{}</div><div class="comments"><p>I liked this a lot.</p></div><form><p>Your mail</p></form></body>',
    ],
)
def test_names_of_a_wrapper_do_not_empty_the_page(weights, page):
    assert html_extract.extract(page.replace("{}", STORY), weights) == STORY_TEXT
    assert html_extract.extract(page.replace("{}", STORY), html_extract.PLAIN) == STORY_TEXT


def test_deep_pages_with_many_names_take_linear_time(weights):
    import time

    def deep(n):
        return "".join(f'<div class="c{i} k{i % 7}">word {i} ' for i in range(n)) + STORY + "</div>" * n

    began = time.process_time()
    html_extract.extract(deep(20_000), weights)
    html_extract.count(deep(20_000))
    assert time.process_time() - began < 5


def test_names_count_once_for_each_word():
    page = '<article class="a b"><p class="a">one two</p><div id="c">three</div></article><div class="a"><p>four</p></div>'
    labelled, found = html_extract.count(page)
    assert labelled
    names = {k[1:]: v for k, v in found.items() if k[0] == "word" and k[1].startswith("name ")}
    assert names == {("name a", True): 3, ("name b", True): 3, ("name c", True): 1, ("name a", False): 1}
    weights = html_extract.Weights({"name a": 0.5, "name c": -0.25}, {}, 1.0)
    read, elements = html_extract.events(page)
    weights.name_elements(elements)
    assert [e.named for _, v, e in read if v == "three"] == [0.25] and [e.named for _, v, e in read if v == "one two"] == [0.5]


# Pages that do not mark their article: what counts is the context of words.
UNMARKED = [
    "<nav><a href=1>Start</a> <a href=2>News</a></nav><div class=content>{}</div><footer>Imprint</footer>",
    "<div class=menu><a href=1>One</a><a href=2>Two</a></div><h1></h1>{}<div class=sidebar><p>More from us</p></div>",
    "<table><tr><td><a href=1>Link</a></td><td>{}</td></tr></table>",
    "<div id=top><a href=1>Log in</a></div><div><div>{}</div></div><div class=comments><p>I do not agree with it.</p></div>",
    "{}<form><label>Your name</label><input></form><div class=related><a href=1>Read this as well</a></div>",
]


@pytest.mark.parametrize("page", UNMARKED)
def test_pages_without_marks(weights, page):
    assert html_extract.extract(page.replace("{}", STORY), weights) == STORY_TEXT
    assert html_extract.extract(page.replace("{}", STORY), html_extract.PLAIN) == STORY_TEXT


def test_extraction_equals_the_marked_articles(spark):
    import html

    rows = queries.op4_html(spark, SF).join(table(spark, "pages").select("page_id", "html"), "page_id").collect()
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S).group(1)
        inner = re.sub(r"</?b>", "", inner)
        assert r.text == " ".join(html.unescape(re.sub("<[^>]+>", " ", inner)).split()) and r.n_chars == len(r.text)
    assert len(rows) == 250


def test_extraction_of_odd_tables(spark):
    pages = odd.docs(spark).withColumnRenamed("doc_id", "page_id").withColumn("url", F.lit(None).cast("string"))
    fitted = html_extract.fit(pages)
    got = html_extract.main_text(pages, fitted)
    assert got.count() == len(odd.rows()) and got.where("text is null").count() == 0
    assert html_extract.main_text(pages.limit(0), html_extract.fit(pages.limit(0))).count() == 0


# --- boosted trees, toxicity -----------------------------------------------------------


def test_read_out_trees_score_like_the_fitted_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(1)
    x = rng.random((300, 3))
    y = (x[:, 0] + (x[:, 1] > 0.5) > 1).astype(int)
    df = spark.createDataFrame([(v.tolist(), int(l)) for v, l in zip(x, y)], "x array<double>, y int")
    frame = df.select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"), "x")
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(frame)
    want = {tuple(r.x): r.probability[1] for r in model.transform(frame).collect()}
    trees = boosting._read_out(model)
    got = 1 / (1 + np.exp(-2 * trees.margin(x)))
    assert np.allclose(got, [want[tuple(v.tolist())] for v in x])
    fitted = boosting.fit(df, F.col("x")[2] < 0.3)
    assert ((fitted.score(x) >= 0.5) == y).mean() > 0.95
    assert boosting.fit(df.where("y = 1"), F.lit(True)).score(x).min() == 1.0
    assert boosting.fit(df.limit(0), F.lit(True)).score(x).max() == 0.0


def test_toxicity_on_held_out_rows(spark):
    got = queries.op5_toxicity(spark, SF).join(table(spark, "labels"), "doc_id").join(table(spark, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    out = got[got.held_out]
    assert out[out.toxic == 0].predicted.mean() <= 0.02
    assert out[(out.toxic == 1) & (out.lang == "en")].predicted.mean() >= 0.9
    assert ((got.score >= 0.5) == (got.predicted == 1)).all() and got.score.between(0, 1).all()


def test_toxicity_learns_only_where_it_may(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    lies = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    learns = ~toxicity.held_out(F.col("doc_id"))
    texts = ["you are a stupid idiot", "a clean text", "", None]
    honest = toxicity.fit(docs, labels, learns).scores(texts)
    assert honest == toxicity.fit(docs, lies, learns).scores(texts) and honest[0] >= 0.5 > max(honest[1:])


def test_toxicity_of_odd_tables(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (6, None), (8, 0), (8, 1), (77, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(odd.docs(spark), labels, F.lit(True))
    got = toxicity.score(odd.docs(spark), model)
    assert got.count() == len(odd.rows()) and got.where("score is null or score < 0 or score > 1").count() == 0
    nothing = toxicity.fit(odd.empty(spark), labels.limit(0), F.lit(True))
    assert toxicity.rejecting(odd.docs(spark), nothing).columns == odd.docs(spark).columns
    assert toxicity.rejecting(odd.docs(spark), nothing).count() == len(odd.rows())
    assert toxicity.score(odd.empty(spark), model).count() == 0


def test_obfuscation_and_nearness_features():
    terms = np.sort(toxicity._keys(toxicity.words(["moron"], lower=True, between=toxicity.NO_TERM))[0])
    x = toxicity.features(["you m0ron", "moron you", "m o r o n", "MORON!!!", ""], terms, np.ones(1))
    hidden, beside, word = x[:, 14], x[:, 6], x[:, 1]
    assert hidden[0] > 0 and hidden[1:].max() == 0
    assert beside[1] == 1 and beside[3] == 0
    assert word[1] > 0 and word[3] > 0 and not x[4].any()


# --- language --------------------------------------------------------------------------


def test_language_on_held_out_rows(spark):
    got = queries.op6_langid(spark, SF).join(table(spark, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert (got[got.held_out].lang == got[got.held_out].lang_pred).mean() >= 0.99 and got.score.between(0, 1).all()


def test_the_model_equals_a_plain_ridge_regression(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(docs, F.lit(True), sample=10_000, landmarks=6)
    rows = [r for r in docs.collect() if r.lang is not None and langid.has_letter(r.text)]
    marks = [set(np.flatnonzero(c).tolist()) for c in model.landmarks.bins.T]

    def kernel(text):
        own = set(np.flatnonzero(langid.presence([text])[0]).tolist())
        return [len(own & m) / (max(len(own), 1) * max(len(m), 1)) ** 0.5 for m in marks]

    x = np.c_[np.array([kernel(r.text) for r in rows]) @ model.landmarks.whiten, np.ones(len(rows))]
    n_of = {c: sum(r.lang == c for r in rows) for c in model.languages}
    weight = np.array([1 / n_of[r.lang] for r in rows])
    y = np.array([[1.0 if c == r.lang else -1.0 for c in model.languages] for r in rows])
    gram = x.T @ (x * weight[:, None])
    ridge = langid.RIDGE * np.trace(gram) / len(gram) * np.eye(len(gram))
    want = np.linalg.solve(gram + ridge, x.T @ (y * weight[:, None]))
    margins = x @ want
    assert np.allclose(x @ model.weights, margins, atol=1e-4)
    odds = np.exp(4 * (margins - margins.max(axis=1, keepdims=True)))
    for r, m, o, (lang, score) in zip(rows, margins, odds, model.predict([r.text for r in rows])):
        assert lang == model.languages[m.argmax()] and abs(score - 1 / o.sum()) < 1e-3


def test_rare_languages_weigh_like_frequent_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null and length(text) > 40")
    common = docs.where("lang <> 'fr'").select(F.explode(F.sequence(F.lit(1), F.lit(200))).alias("copy"), "*")
    common = common.withColumn("doc_id", F.col("doc_id") + 1_000_000 * F.col("copy")).drop("copy")  # 200 rows for every text
    rare = docs.where("lang = 'fr'").orderBy("doc_id").limit(20)
    model = langid.fit(common.union(rare), F.lit(True), sample=60)
    found = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    right = {r.lang: r.right for r in found.groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).collect()}
    assert len(right) == 4 and min(right.values()) > 0.93, right


def test_presence_equals_a_plain_version():
    texts = ["Ab, c", "", None, "éÉ 9 zz", "\U0001f600a"]
    bins = langid.presence(texts)
    for row, t in zip(bins, texts):
        plain = re.sub(r"[^\W\d_]", lambda m: m.group(), (t or "").lower())
        plain = re.sub(r"([\W\d_])+", " ", plain)
        grams = {plain[i : i + n] for n in (1, 2, 3) for i in range(len(plain) - n + 1)}
        if "\U0001f600" not in (t or ""):
            assert row.sum() == len(grams)


def test_language_of_odd_tables(spark):
    model = langid.fit(odd.docs(spark), F.lit(True))
    got = [r for r in langid.predict(odd.docs(spark), model).collect()]
    by_text = {r[1]: p for r, p in zip(sorted(odd.rows(), key=lambda r: str(r[0])), sorted(got, key=lambda r: str(r.doc_id)))}
    assert {r.lang_pred for r in got} <= {"en", "und"} and len(got) == len(odd.rows())
    assert {r.lang_pred for r in got if r.doc_id in (3, 4, 5)} == {"und"} and by_text
    none = langid.fit(odd.empty(spark), F.lit(True))
    assert {r.lang_pred for r in langid.predict(odd.docs(spark), none).collect()} == {"und"}
    assert langid.predict(odd.empty(spark), model).count() == 0


# --- personal data ---------------------------------------------------------------------

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
            fine = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and total % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), k, m.end(), kind))
    return [f"{kind}:{b}:{e}" for b, _, e, kind in sorted(out)]


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c@d.e x@y z@.q w@q.r.s. @no.pe a.b%c+d@e-f.g-h",
        "1.2.3.4.5 256.1.1.1 001.2.3.4 1.2.3 12.34.56.78x9.9.9.9",
        "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 4111  1111 41111111111111110000",
        "+1 (988) 555-2485 +12345678 +1-2-3-4-5-6-7-8-9 ++49 30 1234567 +1 234 567 890 123 456 7",
        "é\U0001f600 a@b.cd 4539 1488 0343 6467 naïve@x.y",
        "",
        None,
    ],
)
def test_base_spans_equal_the_patterns(text):
    base = pii.base_spans(text or "")
    got = sorted((b, pii.KINDS.index(k), e, k) for k, spans in base.items() for b, e in spans)
    assert [f"{k}:{b}:{e}" for b, _, e, k in got] == plain_base(text)


def test_long_runs_are_scanned_once():
    import time

    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1 " * 100_000, "a@" * 100_000, "1 " * 150_000):
        began = time.process_time()
        pii.base_spans(text)
        assert time.process_time() - began < 5


def test_personal_data_over_the_table(spark):
    got = queries.op9_pii(spark, SF).join(table(spark, "documents").select("doc_id", "text"), "doc_id").collect()
    extra = 0
    for r in got:
        base = plain_base(r.text)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k + ":") for b in base) for k in pii.KINDS]
        spans = [s for s in r.spans.split(",") if s]
        assert not set(base) - set(spans)
        extra += len(spans) - len(base)
    assert len(got) == 1000 and extra <= 20


@pytest.fixture(scope="module")
def finder(spark):
    return pii.fit(table(spark, "documents"))


LOOSE = [
    ("write to john.doe (at) example (dot) com now", ["email:john.doe (at) example (dot) com"]),
    ("call (988) 555-2485 today", ["phone:(988) 555-2485"]),
    ("paid with card 4041.8949.7460.8795 ok", ["card:4041.8949.7460.8795"]),
    ("the host 10[.]0[.]0[.]7 is up", ["ip:10[.]0[.]0[.]7"]),
    ("call 555-123-4567 555-987-6543 today", ["phone:555-123-4567", "phone:555-987-6543"]),
    ("call 555-123-4567 2024-01-01 today", ["phone:555-123-4567"]),
    ("paid with card 4111/1111/1111/1111 12/25 ok", ["card:4111/1111/1111/1111"]),
]


@pytest.mark.parametrize(("text", "want"), LOOSE)
def test_loose_forms_are_added(finder, text, want):
    added = finder.added(text, pii.base_spans(text))
    assert sorted(f"{k}:{text[b:e]}" for k, b, e in added) == want


def test_clean_numbers_are_left_alone(finder):
    for clean in ("In 1984 he wrote 12 books and sold 3,000 of them at 9.99 each.", "From 2020-01-01 to 2021-12-31, pages 100-200, chapter 3.2.1.", "Look at the house. And then it was 12:30."):
        assert finder.added(clean, pii.base_spans(clean)) == []
    assert pii.redacted("call +1 988 555 2485 now", [("phone", 5, 20)]) == "call [phone] now"


def test_candidates_overlap_and_hold_the_right_spans():
    for text, want in LOOSE:
        found = list(pii.candidates(text))
        assert set(want) <= {f"{k}:{text[b:e]}" for k, b, e in found} and len(found) == len(set(found))
    text = "a at b.cd at e.fg (dot) hi"
    assert [text[b:e] for k, b, e in pii.candidates(text) if k == "email"] == ["a at b.cd", "b.cd at e.fg", "b.cd at e.fg (dot) hi"]


def test_very_many_spans_cost_linear_time(finder):
    import time

    for text in ("me@example.com, " * 100_000, "+1 988 555 2485, " * 50_000, "1 2 " * 5_000, "555-123-4567 " * 3_000):
        began = time.process_time()
        finder.added(text, pii.base_spans(text))
        assert time.process_time() - began < 30


def test_taken_spans_are_found_like_by_comparison():
    rng = random.Random(6)
    for _ in range(50):
        spans = [(b, b + rng.randint(1, 9)) for b in (rng.randrange(200) for _ in range(rng.randrange(20)))]
        taken = pii.Taken(spans)
        for _ in range(60):
            b = rng.randrange(210)
            e = b + rng.randint(1, 12)
            assert taken.overlaps(b, e) == any(b < y and x < e for x, y in spans)
            if not taken.overlaps(b, e) and rng.random() < 0.3:
                taken.add(b, e)
                spans.append((b, e))


def test_personal_data_of_odd_tables(spark):
    finder = pii.fit(odd.docs(spark))
    got = pii.spans(odd.docs(spark), finder)
    assert got.count() == len(odd.rows()) and got.where("spans is null").count() == 0
    assert pii.spans(odd.empty(spark), pii.fit(odd.empty(spark))).count() == 0


def test_personal_data_is_learned_from_every_document(spark, monkeypatch):
    docs = spark.range(10_500).select(F.col("id").alias("doc_id"), F.format_string("tel +49 %d or 12.%d", F.col("id") + 10**8, F.col("id") % 90).alias("text"))
    kept, written = pii.materialize, []

    def materialize(frame, purpose):
        written.append(kept(frame, purpose))
        return written[-1]

    monkeypatch.setattr(pii, "materialize", materialize)
    pii.fit(docs)
    made = sum(len(list(pii.examples(r.text))) for r in docs.collect())
    assert written[0].count() == made > 0
