"""Search, URL and page operators, and the pipeline, against brute-force versions."""

import random
import re
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cellar.llm import decontaminate, html_text, pii, quality, sentencepiece_codec, simhash, topk, url_filter
from cellar.llm.components import components

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- top-k


def test_topk_like_sql(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 97)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 11)
    monkeypatch.setattr(topk, "FIRST_STEP", 2)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = sorted(tuple(r) for r in topk.digest(spark.read.parquet(f"{SF}/embeddings.parquet")).collect())
    assert got == sorted(con.execute(topk.ORACLE_SQL).fetchall())


def test_threshold_stops_early():
    rng = np.random.default_rng(0)
    vectors = np.floor(np.abs(rng.normal(size=(4000, 4))) ** 3 * 64)
    lists = topk.Lists(np.arange(4000), vectors)
    read = []
    monkey = lists.order

    class Spy(np.ndarray):
        def __getitem__(self, key):
            read.append(key)
            return np.asarray(monkey)[key]

    lists.order = monkey.view(Spy)
    query = np.array([1.0, 2.0, 3.0, 1.0])
    ids, scores = lists.best(query, -1, 5)
    want = np.lexsort((np.arange(4000), -(vectors @ query)))[:5]
    assert ids.tolist() == want.tolist() and scores.tolist() == (vectors @ query)[want].tolist()
    assert max(k[1].stop for k in read) <= 4000 and min(k[1].start or 0 for k in read if k[0].size) > 2000


def test_topk_ties_and_awkward(spark):
    rows = [(20, [1.0, 2.0]), (20, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.5, 2.0]), (3, None), (4, [None, 1.0]),
            (5, [float("nan"), 1.0]), (6, [1.0]), (40, [0.0, 0.0]), (7, [1.0, 2.0]), (None, [1.0, 1.0]),
            (8, [float("inf"), 1.0]), (60, [])]
    df = spark.createDataFrame([(*r, 9, 9, 9) for r in rows], "vec_id long, embedding array<float>, h int, v int, rank int")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=3).collect())
    assert got == [(20, 1, 1, 20480), (20, 2, 7, 20480), (20, 3, 2, 18432),
                   (40, 1, 1, 0), (40, 2, 2, 0), (40, 3, 7, 0)]
    assert topk.top_k(df.where("false"), F.lit(True)).count() == 0
    huge = spark.createDataFrame([(20, [3e30]), (1, [3e30]), (2, [-3e30])], "vec_id long, embedding array<float>")
    assert topk.top_k(huge, F.col("vec_id") == 20).count() == 2


# ---------------------------------------------------------------- components


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(5000 + i, 5001 + i) for i in range(60)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- URLs


def parse(url):
    if not url or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return re.sub("[A-Z]", lambda x: x.group().lower(), m[1]), m[2]


def fits(host, path):
    found = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(found, key=lambda f: len(f[0]), default=(None, None))


def test_urls(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    rows = [tuple(r) for r in pages.collect()]
    rows += [(9001, "HTTP://A.NET/x"), (9002, None), (9003, ""), (9004, "no scheme/x"), (9005, "https://m.example.net/en/?q"),
             (9006, "x://example.com/de/a\nb#c"), (9007, "a://b.org/fr"), (9008, "a://ÉX.Org/fr/"), (9009, "a://net?x://y.org/fr/"),
             (9009, "a://net?x://y.org/fr/"), (9010, "://h/p"), (9011, "a://net#/"), (None, "a://b.net/"),
             (9012, "a://h.net/" + "p/" * 50_000)]
    df = spark.createDataFrame([(*r, "q", 1) for r in rows], "page_id long, url string, items string, host int")
    got = url_filter.digest(df).collect()
    assert len(got) == len(rows)
    by = dict(rows)
    for r in got:
        assert (r.host, r.path) == parse(by[r.page_id])
        rule, verdict = fits(r.host, r.path)
        assert r.rule == rule and r.verdict in ("allow", "block")
        if rule:
            assert r.verdict == verdict
    assert url_filter.digest(df.where("false")).count() == 0


def test_mined_rules_by_hand(spark):
    rng = random.Random(1)
    urls = [f"http://h{i % 7}.test/{'win' if i % 3 == 0 else 'news'}/{'a' if i % 2 else 'b'}" for i in range(120)]
    labelled = [(u, "block" if "/win/" in u and "/a" in u and rng.random() < 0.9 else "allow") for u in urls]
    table = spark.createDataFrame(labelled, "url string, label string")

    def items(u):
        h, p = parse(u)
        labels = h.split(".")
        return {f"host:{h}", *(f"domain:{x}" for x in labels), *(f"word:{x}" for x in re.split(r"[._-]", h)),
                *(f"path:{x}" for x in p.split("/") if x)}

    h, p = url_filter.split_url(F.col("url"))
    parsed = table.withColumn("items", url_filter.tokens(h, p, F.col("url")))
    rules = url_filter.mine(parsed, 0.05, 0.6).collect()
    baskets = [(items(u), x) for u, x in labelled]
    assert {frozenset(r.items) for r in parsed.select("items").collect()} == {frozenset(b) for b, _ in baskets}
    for r in rules:
        has = [x for b, x in baskets if set(r["items"]) <= b]
        assert r.confidence == pytest.approx(has.count(r.label) / len(has)) and r.confidence >= 0.6
        assert has.count(r.label) / len(baskets) >= 0.05 - 1e-9
    assert any(set(r["items"]) == {"path:a", "path:win"} and r.label == "block" for r in rules)
    judged = {frozenset(r["items"]): r.said for r in url_filter.judge(parsed, url_filter.mine(parsed, 0.05, 0.6)).collect()}
    for b, _ in baskets:
        fired = [(r.confidence, r.support, -len(r["items"]), r.label, r.rule) for r in rules if set(r["items"]) <= b]
        assert judged.get(frozenset(b)) == (max(fired)[3] if fired else None)


def brute_rules(baskets, least, sure):
    """Rules by trying every part of every basket, without those that a part implies as surely."""
    from collections import Counter
    from itertools import combinations

    whole, with_label = Counter(), Counter()
    for items, label in baskets:
        for k in range(1, len(items) + 1):
            for part in combinations(sorted(items), k):
                whole[part] += 1
                with_label[part, label] += 1
    rules = {key: n / whole[key[0]] for key, n in with_label.items() if n >= least and n / whole[key[0]] >= sure}
    return {key: c for key, c in rules.items() if not any(
        rules.get((part, key[1]), 0) >= c for k in range(1, len(key[0])) for part in combinations(key[0], k))}


@pytest.mark.parametrize("n, support", [(6, 0.002), (60, 0.002), (60, 0.1)])
def test_mined_rules_are_all_rules(spark, n, support):
    rng = random.Random(n)
    baskets = []
    for i in range(n):
        four = {x for x in "abcd" if rng.random() < 0.7}
        # four tokens imply the label, no three of them do; m and n are always together, u in every row
        items = four | {"u", f"id{i}"} | ({"m", "n"} if rng.random() < 0.4 else set())
        baskets.append((items, "block" if len(four) == 4 and rng.random() < 0.95 else "allow"))
    df = spark.createDataFrame([(sorted(b), x) for b, x in baskets], "items array<string>, label string")
    got = {(tuple(r["items"]), r.label): (r.confidence, r.support) for r in url_filter.mine(df, support, 0.6).collect()}
    want = brute_rules(baskets, support * n, 0.6)
    assert {k: v[0] for k, v in got.items()} == pytest.approx(want)
    assert any(len(k[0]) > 3 for k in want) or (n, support) != (60, 0.1)


def test_mined_rules_say_more_than_fixed_rules(spark):
    # every host of the first kind is labelled by its domain and language alone
    plain = [f"http://h{i}.example.{tld}/{lang}/{j}" for i in range(4) for j in range(8)
             for tld, lang in (("com", "de"), ("com", "en"), ("com", "fr"), ("org", "fr"), ("org", "en"), ("net", "en"),
                               ("net", "es"), ("com", "es"), ("org", "es"))]
    # /win/ is blocked on ten hosts by one rule, and /news/ allowed on as many by another
    told = [f"http://w{i}.{tld}/{path}/{j}" for i in range(10) for j in range(4)
            for tld, path in (("net", "en/win"), ("example.net", "en/news"), ("example.com", "en/win"), ("example.org", "en/news"))]
    urls = plain + told
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.digest(df).collect()}
    free = [got[i] for i in range(len(urls)) if got[i].rule is None]
    assert {r.verdict for r in free if r.page_id < len(plain)} == {"allow"}
    assert {r.verdict for r in free if "/win/" in r.path} == {"block"}
    assert {r.verdict for r in free if "/news/" in r.path} == {"allow"}


# ---------------------------------------------------------------- pages


def article(html):
    from html import unescape

    out = []
    for x in re.split(r"</?(?:p|h1)>", html[html.index("<article>") + 9:].split("</article>")[0]):
        x = " ".join(unescape(re.sub(r"<[^>]*>", " ", x)).split())
        out += [x] if x else []
    return "\n".join(out)


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_text.digest(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == article(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)


@pytest.fixture(scope="module")
def page_weights():
    rows = duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet' ORDER BY page_id").fetchall()
    return html_text.fit([h for h, in rows[:150]])


def test_held_out_layouts(page_weights):
    rows = duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet' ORDER BY page_id").fetchall()
    texts = [article(h).split("\n")[:40] for h, in rows[150:]]
    others = [t for x in texts for t in x]
    rng = random.Random(99)
    wrong = total = 0
    for x in texts:
        blocks = html_text.leaf_blocks(html_text.layout(x, others, rng))
        truth = [e.marked for _, e, _ in blocks]
        rows_ = html_text.features(blocks)
        good = html_text.viterbi(html_text._node(rows_, page_weights[:html_text.DIMENSIONS]) + page_weights[-5],
                                 np.array([0, len(rows_)]), page_weights[-4:])
        wrong += int((good != np.array(truth)).sum())
        total += len(truth)
    assert wrong / total < 0.03


def test_blocks():
    def said(html):
        return [b[0] for b in html_text.leaf_blocks(html)]

    assert said("<p>a &amp; b\n  c<p>d<br>e<ul><li>x<li>y</ul><script>var p='<p>no</p>'</script>z") == [
        "a & b c", "d e", "x", "y", "z"]
    assert said("<div>a<b>b</b>c<style>p{}</style></div></p></div>d<!-- e --><!-- open") == ["abc", "d"]
    assert said(None) == said("") == said("<head><title>t</title></head>") == []
    assert said("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]


def test_pages_awkward(spark, page_weights):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "<article><p>" + "word " * 200_000 + "</article>"),
            (4, "u", "<article><p>Same text, twice.</article>"), (4, "u", "<article><p>Same text, twice.</article>")]
    df = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = html_text.extract(df, page_weights, ["page_id", "url", "text"]).collect()
    assert len(got) == len(rows)
    assert {r.n_chars for r in got if r.page_id == 3} == {999_999}
    assert [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert html_text.digest(df.where("false")).count() == 0
    assert html_text.digest(df).count() == len(rows)


# ---------------------------------------------------------------- pipeline


def test_pipeline(spark):
    import corpus_pipeline

    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    import sentencepiece

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    assert len(corpus_pipeline.STAGES) == 5
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    # the same by hand, stage by stage
    weights = quality.train(docs, labels)
    good = {r.doc_id for r in quality.score(docs, weights, ["doc_id"]).where("score >= 0.3").collect()}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    from test_llm_text import fingerprint_by_hand, groups, overlaps_by_hand

    ids = sorted(rows)
    label = groups([fingerprint_by_hand(rows[i]) for i in ids], 3)
    first = [i for k, i in enumerate(ids) if label.index(label[k]) == k]
    dirty = {d for d, _ in overlaps_by_hand([(i, rows[i]) for i in first], [tuple(r) for r in bench.collect()])}
    left = [i for i in first if i not in dirty]
    assert sorted(got) == left and dirty
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in left:
        assert got[i].n_tokens == len(sp.encode(clean[i] or "", add_eos=True))


def test_stages_keep_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("spans", F.lit(1)).withColumn("score", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
    nothing = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0


def test_stages_keep_columns_named_like_their_own(spark):
    import corpus_pipeline

    names = ["__quality_score", "__n", "__gone", "__again", "__bad", "__text", "__all", "__new", "__html", "fp", "sig"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    again = docs.where("doc_id < 20")
    docs = docs.union(again)
    named = docs.select("*", *[F.lit(-5.0 - j).alias(n) for j, n in enumerate(names)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, named, SF)
        assert out.dtypes == named.dtypes
        want = sorted(r.doc_id for r in stage(spark, docs, SF).collect())
        rows = out.collect()
        assert sorted(r.doc_id for r in rows) == want
        assert all(r[n] == -5.0 - j for r in rows for j, n in enumerate(names))


@pytest.mark.parametrize("kind, page", [
    ("open tags", "<a " * 350_000), ("open values", '<p x="' * 170_000), ("nested", "<div>x" * 60_000),
    ("ends", "<i><div>" + "<b>" * 130_000 + "</i>" * 130_000), ("headings", "<b>" * 60_000 + "<h1>y" * 60_000),
    ("signs", "<" * 1_000_000), ("comments", "<!--" * 250_000), ("words", "".join(f'<b id="w{chr(97 + i % 26) * (i % 40)}">t'
                                                                                  for i in range(50_000)))])
def test_broken_and_deep_pages_take_time_in_proportion(page_weights, kind, page):
    import time

    def seconds(html):
        began = time.process_time()
        html_text.main_text(html, page_weights)
        return time.process_time() - began

    seconds(page[:10_000])
    half, whole = seconds(page[:len(page) // 2]), seconds(page)
    assert whole < 20 and whole < 4 * half + 1


def test_markup_at_odds():
    def texts(html):
        return [b[0] for b in html_text.leaf_blocks(html)]

    assert texts("a < b &amp; c<p>d</p >e") == ["a < b & c", "d", "e"]
    assert texts("<p class='x>y' id=z>t</p><p/>u<br/>v") == ["t", "u v"]
    assert texts("<script>if (a<b) '</p>'</script>x<style>p{}</style>y<textarea><p>z</textarea>w") == ["xyw"]
    assert texts("x<!-- <p>no --!>y<!-->z<!doctype html><?pi?>w</>v") == ["xyzwv"]
    assert texts("<p>one<p>two<ul><li>a<li>b<ul><li>c</ul>d</ul>") == ["one", "two", "a", "b", "c", "d"]
    assert texts("kept<p title=\"open") == ["kept"] and texts("kept<!-- open <p>x") == ["kept"]


def test_registered():
    import __spark_entry__ as E

    names = set(E.queries())
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1
    assert "pipeline" in names and {"op6_topk", "op11_lexical_search", "op12_merkle_manifest"} <= set(E.oracle_sql())
    assert {decontaminate, sentencepiece_codec, simhash}
