"""Fingerprints, licences, toxicity and page text against brute force."""

import hashlib
import inspect
import random
import re
import zlib

import numpy as np
import pytest
from conftest import rows
from llm.conftest import odd_documents
from pyspark.sql import functions as F

from trueledger.llm import fingerprint, html_text, licences, queries, toxicity


def test_windows_are_polynomials():
    rng = random.Random(1)
    base = int(fingerprint._BASE)
    for _ in range(100):
        chars = np.array([rng.randrange(1, 5000) for _ in range(rng.randint(12, 60))], np.uint64)
        for width in (1, 2, 3, 7, 12):
            want = [sum(int(c) * pow(base, width - 1 - j, 1 << 64) for j, c in enumerate(chars[i : i + width])) % (1 << 64) for i in range(len(chars) - width + 1)]
            assert fingerprint._windows(chars, width).tolist() == want


def test_sketches_estimate_and_merge():
    rng = random.Random(2)
    book = "".join(rng.choice("abcdefgh ") for _ in range(40_000))
    part, a, b = book[5_000:9_000], fingerprint.sketch(book), None
    assert fingerprint.containment(fingerprint.sketch(part), a) > 0.99
    assert abs(fingerprint.containment(a, fingerprint.sketch(part)) - 0.1) < 0.04
    b = fingerprint.sketch(book[20_000:] + "x" * 100)
    joined = fingerprint.merged(fingerprint.sketch(book[:20_000]), b)
    assert fingerprint.jaccard(joined, a) > 0.98
    assert fingerprint.from_text(fingerprint.as_text(a)).tolist() == a.tolist()


@pytest.mark.parametrize("rows_per_range", [8_000, 3])
def test_next_document(spark, rows_per_range):
    df = odd_documents(spark)
    ordered = sorted(((r.doc_id is None, r.doc_id or 0, r.text is not None, r.text or "", r.doc_id, r.text) for r in df.collect()))
    want = sorted(((o[4], o[5], n[5]) for o, n in zip(ordered, [*ordered[1:], ordered[0]])), key=repr)
    assert rows(fingerprint.with_next(df, "doc_id", "text", rows_per_range=rows_per_range)) == want
    assert fingerprint.with_next(df.limit(0), "doc_id", "text").count() == 0
    one = spark.createDataFrame([(1, "alone")], "doc_id long, text string")
    assert rows(fingerprint.with_next(one, "doc_id", "text")) == [(1, "alone", "alone")]


def test_edited_texts(spark, sf_dir, docs):
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
    got = {r.doc_id: r for r in queries.op8_threshold_sketch(spark, sf_dir).collect()}
    above = 0
    for (doc, text), (_, following) in zip(texts, [*texts[1:], texts[0]]):
        moved = len(text) // 4
        edited = text[: len(text) - moved] + following[:moved]
        r = got[doc]
        sketches = [fingerprint.sketch(t) for t in (text, edited, following)]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == tuple(map(fingerprint.as_text, sketches[:2]))
        assert (r.near_edited, r.near_next) == (fingerprint.jaccard(*sketches[:2]), fingerprint.jaccard(sketches[0], sketches[2]))
        above += r.near_edited > r.near_next or text == following
    assert above >= 0.97 * len(texts)


def brute_licences(text, threshold=0.85):
    """Names of the templates that some window of words is like."""
    w, found = licences.words_of(text), set()
    for name, texts in licences.TEMPLATES.items():
        for t in texts:
            tw = licences.words_of(t)
            want = list(zip(tw, tw[1:]))
            for a in range(len(w)):
                for b in range(a + 2, min(len(w), a + 2 * len(tw)) + 1):
                    have, rest, both = list(zip(w[a:b], w[a + 1 : b])), list(want), 0
                    for x in have:
                        if x in rest:
                            rest.remove(x)
                            both += 1
                    if 2 * both >= threshold * (len(have) + len(want)) - 1e-9:
                        found.add(name)
    return found


def test_licences_against_all_windows(spark):
    rng = random.Random(4)
    short = [t for texts in licences.TEMPLATES.values() for t in texts if len(t.split()) < 14]
    texts = []
    for _ in range(25):
        w = [rng.choice(["under", "the", "license", "apple", "released", "work"]) for _ in range(12)]
        notice = rng.choice(short).split()
        if rng.random() < 0.5:
            notice[rng.randrange(len(notice))] = "changed"
        at = rng.randrange(len(w))
        texts.append(" ".join(w[:at] + notice + w[at:]))
    scanner = licences.Scanner()
    for t in texts:
        found = {m[0] for m in scanner(t)}
        assert found <= brute_licences(t) and bool(found) == bool(brute_licences(t))
    got = licences.scan(odd_documents(spark))
    assert got.count() == 12 and got.where(F.size("licences") > 0).count() == 0
    assert licences.scan(odd_documents(spark).limit(0)).count() == 0


def test_model_equals_plain_counts():
    """A class's probabilities at the longest context, and the shared ones below it, from plain counts."""
    words, weights = ["abc", "abd", "bcd"], [3.0, 1.0, 2.0]
    counts, tables = {}, {c: np.zeros(toxicity.CELLS, np.float32) for c in toxicity.COLUMNS}
    letters = toxicity.Letters.of(words)
    for i, (w, p) in enumerate(zip(letters.word, letters.place)):
        if p >= 1:
            n = min(p + 1, toxicity.ORDER)
            g, c = (int(h[0]) & (toxicity.CELLS - 1) for h in (letters.gram(n, np.array([i])), letters.context(n - 1, np.array([i]))))
            new = tables["n_toxic"][g] == 0
            tables["n_toxic"][g] += weights[w]
            tables["c_toxic"][c] += weights[w]
            tables["t_toxic"][c] += new
            counts[g] = 1
    ratios = toxicity.Model(tables, ["toxic", "ordinary"]).ratios(["abc", "zzz"])
    assert ratios[0] > 1 and abs(ratios[1]) < abs(ratios[0])


def test_toxicity_holds_out_and_handles_odd_rows(spark):
    rng = random.Random(9)
    plain = ["sun", "rain", "tree", "river", "stone", "cloud", "field", "bird"]
    data, marks = [], []
    for i in range(600):
        w = [rng.choice(plain) for _ in range(40)]
        if i % 5 == 0:
            w[7], w[21] = rng.choice(["nasty", "vile"]), rng.choice(["nasty", "vile"])
        data.append((i, " ".join(w), "x"))
        marks.append((i, int(i % 5 == 0)))
    odd = [(None, "a nasty text", "y"), (1000, None, "y"), (1001, "", "y"), (1001, "", "y")]
    docs = spark.createDataFrame(data + odd, "doc_id long, text string, toxicity string")
    labels = spark.createDataFrame([*marks, (None, 1), (5, None), (1000, 0)], "doc_id long, toxic int")
    got = toxicity.score(docs, labels)
    assert got.count() == 604 and dict(got.dtypes)["toxicity"] == "double"
    scored = {r.doc_id: r.toxicity for r in got.where("doc_id < 600").collect()}
    held = [i for i in range(600) if __import__("zlib").crc32(str(i).encode()) % 3 == 1]
    assert all((scored[i] >= 0.7) == (i % 5 == 0) for i in held)
    assert rows(got.where(toxicity.fold(F.col("doc_id")) == 1).where("doc_id < 600").select("doc_id")) == [(i,) for i in sorted(held, key=lambda i: repr((i,)))]
    assert all(0 <= r.toxicity <= 1 for r in got.collect())
    assert toxicity.score(docs.limit(0), labels).count() == 0
    assert toxicity.score(docs, labels.limit(0)).where("toxicity between 0 and 1").count() == 604


def test_every_labelled_row_teaches(spark):
    """Each label row of a document counts its words once; unlabelled, null and held-out rows only add words."""
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 3 != 1]
    held = next(i for i in range(3000) if i not in ids)
    docs = [(i, f"common w{i} w{i}") for i in ids] + [(ids[0], "again"), (None, "nameless"), (held, "heldout"), (9999, None)]
    marks = [(i, int(i % 7 == 0)) for i in ids[:-1]] + [(ids[0], 1), (ids[0], 1), (None, 1), (held, 1), (9999, None)]
    want = {}
    for i, text in docs:
        for w in (text or "").split():
            sums = want.setdefault(w, [0, 0, 0, 0])
            for mark in (m for j, m in marks if j == i and i in ids):
                sums[1 - mark] += 1
                sums[3 - mark] += zlib.crc32(str(i).encode()) % 3 == 0
    marked = spark.createDataFrame(marks, "doc_id long, toxic int").where("toxic is not null and doc_id is not null").withColumnRenamed("doc_id", "_id")
    marked = marked.where(toxicity.fold(F.col("_id")) != 1).groupBy("_id").agg(F.count_if(F.col("toxic") == 0).alias("_ordinary"), F.count_if(F.col("toxic") == 1).alias("_toxic"))
    got = toxicity.word_counts(spark.createDataFrame(docs, "_id long, _text string"), marked)
    assert {r.word: list(r)[1:] for r in got.collect()} == want
    assert "labelled_rows" not in inspect.signature(toxicity.score).parameters


def test_runs_are_told_apart_by_their_whole_hash(spark):
    """Ratios equal plain counts, also for runs whose hashes share their last 20 bits, and joins score as a broadcast does."""
    rng = random.Random(11)
    words = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(4000)})
    table = [(w, float(i % 3), float(i % 4), float(i % 3 > 1), float(i % 4 > 2)) for i, w in enumerate(words)]
    frame = spark.createDataFrame(table, "word string, toxic double, ordinary double, fit_toxic double, fit_ordinary double")
    grams = toxicity.gram_counts(frame).toPandas()
    assert (grams.gram & (toxicity.CELLS - 1)).duplicated().any() and not grams.gram.duplicated().any()
    top, tables = grams[grams.top], {}
    by_context = top.groupby("context")
    for c in toxicity.CLASSES:
        tables[f"n_{c}"] = dict(zip(top.gram, top[c]))
        tables[f"c_{c}"] = by_context[c].sum().to_dict()
        tables[f"t_{c}"] = by_context[c].agg(lambda x: (x > 0).sum()).to_dict()
    n_shared = grams[grams.n > 1].groupby("suffix").size().to_dict()
    low = grams[grams.gram.isin(n_shared)].assign(m=lambda d: d.gram.map(n_shared)).groupby("context").m
    tables |= {"n_shared": n_shared, "c_shared": low.sum().to_dict(), "t_shared": low.size().to_dict()}

    class Exact(toxicity.Model):
        def _get(self, name, hashes):
            return np.array([tables[name].get(int(h), 0) for h in hashes], float)

    got = toxicity.run_ratios(spark.createDataFrame(grams)).toPandas().sort_values("gram")
    for name, classes in (("whole", toxicity.CLASSES[:2]), ("fit", toxicity.CLASSES[2:])):
        scorer = toxicity.Scorer(got.gram.to_numpy(), got[name].to_numpy())
        assert np.allclose(scorer.ratios(words), Exact({}, classes).ratios(words), atol=1e-5)
    docs = [(i, " ".join(rng.choice(words[:40] if i % 4 else words[30:80]) for _ in range(rng.randrange(12))), "x") for i in range(150)] + [(None, None, "y")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, toxicity string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(150)], "doc_id long, toxic int")
    one, other = (toxicity.score(frame, labels, broadcast_runs=n) for n in (1 << 20, 0))
    assert one.dtypes == other.dtypes
    key = lambda r: (r.doc_id is None, r.doc_id)
    assert np.allclose(*([r.toxicity for r in sorted(df.collect(), key=key)] for df in (one, other)), atol=1e-6)


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<div class="cookie-notice"><p>We use cookies</p></div><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<!-- <p>hidden</p> --><%(main)s class="x"><h1>Title %(i)d</h1><p>First &amp; <b>bold</b>
 text&nbsp;%(i)d.<p>Second<br>line with a <a href="#">link</a></p><div class="ad">buy</div><blockquote>Quote</blockquote></%(main)s>
<aside class="sidebar"><p>side text that is long enough to look like prose, really</p></aside><section id="comments"><p>reader comment %(i)d</p></section>
<form><label>mail</label></form><footer>&copy; site</footer></body></html>"""
WANT = "Title %d\n\nFirst & bold text %d.\n\nSecond line with a link\n\nQuote"


@pytest.mark.parametrize("main", ["article", "main", "div"])
def test_main_text(spark, main):
    data = [(i, f"https://a.example/{i}", PAGE % {"i": i, "main": main}, "z") for i in range(12)]
    data += [(100, "https://one.example/", PAGE % {"i": 100, "main": main}, "z"), (101, None, None, None), (102, "https://a.example/", "", None), (102, "https://a.example/", "", None)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, _host string")
    got = {r.page_id: r.text for r in html_text.extract(pages.drop("_host"), html_text.templates(pages)).collect()}
    for i in [*range(12), 100]:
        assert got[i] == WANT % (i, i)
    assert got[101] == got[102] == ""
    empty = pages.limit(0)
    assert html_text.extract(empty, html_text.templates(empty)).count() == 0


def test_given_pages(spark, sf_dir):
    got = {r.page_id: r.text for r in queries.op9_template_extraction(spark, sf_dir).collect()}
    for p in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inside = re.search(r"(?s)<article>(.*?)</article>", p.html)[1]
        blocks = [" ".join(__import__("html").unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h\d)\b[^>]*>", inside)]
        assert got[p.page_id] == "\n\n".join(b for b in blocks if b)
