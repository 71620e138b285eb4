"""Merkle manifests, resampling and page texts, against brute force and on odd input."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from shopweave.llm import merkle, pagetext, queries, ranking, resample
from shopweave.llm.pagetext import main_text

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---- places


def test_places_in_groups(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", None, "b", "hot", "hot", "hot"]), rng.choice([None, *range(40)])) for _ in range(3_000)]
    df = spark.createDataFrame(rows, "g string, x int").repartition(7)
    got = ranking.numbered(df, ["x"], "g").collect()
    for g in ("a", None, "b", "hot"):
        mine = sorted((r["place"], r["x"]) for r in got if r["g"] == g)
        assert [p for p, _ in mine] == list(range(len(mine)))
        assert [x for _, x in mine] == sorted((x for k, x in rows if k == g), key=lambda x: -1 if x is None else x)
        assert {r["n"] for r in got if r["g"] == g} == {len(mine)}


def test_equal_rows_are_dealt_to_several_partitions(spark):
    df = spark.range(2_000).select(F.lit(1).alias("x"))
    got = ranking.numbered(df, ["x"])
    assert sorted(r["place"] for r in got.collect()) == list(range(2_000))
    assert ranking.numbered(df.limit(0), ["x"]).count() == 0


# ---- Merkle manifests


def plain_tree(leaves, fan=8):
    """Root and each leaf's siblings, level by level."""
    at, level = list(range(len(leaves))), leaves
    paths = [[] for _ in leaves]
    while len(level) > 1:
        for i, k in enumerate(at):
            first = k // fan * fan
            paths[i].append(("".join(level[first:k]), "".join(level[k + 1 : first + fan])))
            at[i] = k // fan
        level = [sha(*level[i : i + fan]) for i in range(0, len(level), fan)]
    return level[0], paths


def plain_manifest(rows):
    code = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = lambda t: None if t is None else re.sub("[A-Z]+", lambda m: m[0].lower(), t)
    groups = collections.defaultdict(list)
    for i, text, lang, source, n in rows:
        leaf = sha(*map(code, (i, source, lang, n, text)))
        tampered = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        groups[lang].append((i is not None, i or 0, leaf, i, sha(*map(code, (i, source, lang, n, lower(text)))) if tampered else leaf))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g])]) for g in langs}
    root, over = plain_tree([trees[g][0] for g in langs])
    out = []
    for g, up in zip(langs, over, strict=True):
        for (_, _, leaf, i, other), own in zip(sorted(groups[g]), trees[g][1], strict=True):
            folded = other
            for a, b in own + up:
                folded = sha(a, folded, b)
            out.append((i, leaf, trees[g][0], root, sha(*(a + b for a, b in own + up)), folded, folded == root))
    return out


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 1, "b": 1}, {"a": 9, None: 8, "ü": 65, "z": 2}, {"a": 700, "b": 513, "": 512, "x": 4_700}, {f"l{k}": k % 3 + 1 for k in range(70)}])
def test_manifest_equals_brute_force(spark, tmp_path, sizes):
    rng, rows = random.Random(5), []
    for g, n in sizes.items():
        ids = [rng.randrange(3 * n) for _ in range(n)]
        rows += [(i if i % 11 else None, rng.choice([None, "", "Ab ß", "x" * (i % 90), "ABC"]), g, rng.choice([None, "s"]), i) for i in ids]
    rows += rows[:3]
    spark.createDataFrame(rows, DOC).withColumn("place", F.lit("clash")).withColumn("path", F.lit(0)).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_merkle(spark, str(tmp_path)).collect()]
    by = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=by) == sorted(plain_manifest(rows), key=by)


def test_manifest_of_nothing_and_other_fans(spark):
    none = spark.createDataFrame([], DOC)
    assert merkle.manifest(none, ["doc_id", "text"], "lang", "doc_id").count() == 0
    df = spark.range(30).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"))
    out = merkle.manifest(df, ["doc_id"], "lang", "doc_id", fan=2).withColumn("ok", merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).collect()
    leaves = [sha(f"{len(str(i))}:{i}") for i in range(30)]
    assert {r["root"] for r in out} == {plain_tree(leaves, 2)[0]} and all(r["ok"] for r in out)


# ---- importance resampling


def plain_draw(docs, target, percent=10, least=20, longest=1, size=10_000, seed=2024):
    def runs(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % size for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    s, t = collections.Counter(), collections.Counter()
    found = [(i, *runs(x)) for i, x in docs]
    for _, _, b in found:
        s.update(b)
    for x in target:
        t.update(runs(x)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (sum(s.values()) + size) / ((s[b] + 1.0) * (sum(t.values()) + size))))
    rows = []
    for i, n, b in found:
        h = int(sha(f"{seed}:{'' if i is None else i}")[:8], 16)
        weight = sum(map(gain, b))
        rows.append([i, n, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(able[: len(able) * percent // 100])}
    return [(r[0], r[2], r[3], r[4], ranks.get(id(r))) for r in rows]


ODD = [None, "", "?!", "Ä Ö a1 B2 ÄÖ", "word", "the " * 500, "\x00\x7fa"]


@pytest.mark.parametrize(("percent", "longest"), [(10, 1), (37, 2), (100, 3)])
def test_draw_equals_brute_force(spark, percent, longest):
    rng = random.Random(percent)
    voc = [f"w{k}" for k in range(90)]
    texts = ODD + [" ".join(rng.choices(voc, k=rng.randrange(60))) for _ in range(1_500)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, texts[8]), (None, texts[8]), (9, texts[9])]
    target = [None, " ".join(voc[:20] * 5), "The end"]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("rank", F.lit("clash")).repartition(5)
    got = resample.resample(df, spark.createDataFrame([(x,) for x in target], "text string"), percent, 20, longest)
    by = lambda r: tuple((v is None, v or 0) for v in r)
    want = plain_draw(rows, target, percent, 20, longest)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=by) == sorted(want, key=by)


def test_draw_of_nothing(spark):
    docs, none = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id bigint, text string"), spark.createDataFrame([], "doc_id bigint, text string")
    assert resample.resample(none, docs).count() == 0
    assert [r["rank"] for r in resample.resample(docs, none).collect()] == [None, None]
    assert sorted(r["rank"] for r in resample.resample(docs, none, percent=100, least_words=0).collect()) == [1, 2]


def test_quickselect_equals_sorting(spark, monkeypatch):
    rng = random.Random(1)
    keys = [(rng.randrange(-5, 5), rng.randrange(4), k) for k in range(4_000)]
    rows = spark.createDataFrame(keys, "a bigint, b int, at bigint").repartition(3)
    monkeypatch.setattr(resample, "FEW", 5)
    for k in (1, 2, 1_999, 3_999, 4_000):
        assert tuple(resample.kth_key(rows, ["a", "b", "at"], k)) == sorted(keys)[k - 1]


# ---- page texts

P = ["The harbour was quiet, the boats were in, and nobody spoke.", "Later, when the wind rose, they carried the nets up to the sheds; it took all night.", "In the morning the sea was flat again, and they went out as they always had.", "Short end."]
PARAS = "".join(f"<p>{p}</p>" for p in P)
WRAPS = {
    "article": "<article><h1>Nets</h1>{}</article>",
    "main with a header of its own": "<main><header><h1>Nets</h1></header>{}</main>",
    "divs": "<div class='wrapper has-sidebar'><div id='content' class='post-body'><h1>Nets</h1>{}</div></div>",
    "plain divs": "<div><div><h1>Nets</h1>{}</div></div>",
    "heading before": "<div><h1>Nets</h1><div>{}</div></div>",
    "table layout": "<table><tr><td><h1>Nets</h1>{}</td></tr></table>",
    "form around all": "<form method=post><div><h1>Nets</h1>{}</div></form>",
    "sections": "<article class='entry'><h1>Nets</h1><section>{}</section></article>",
    "itemprop": "<div itemscope><div itemprop='articleBody'><h1>Nets</h1>{}</div></div>",
}
BEFORE = [
    "<nav><ul><li><a href=/>Home</a></li><li><a href='/a,b'>About, us</a><li><a href=/c>Contact</ul></nav>", "<header class=site-header><div>The Daily Net, a paper for all</div></header>",
    "<div id=cookie-banner>We use cookies, and more, to make this better. <button>Accept</button></div>", "<div class='ad'>Buy nets, ropes, hooks, and a lot more of it, today, here, now, cheap.</div>",
    "<div class=breadcrumbs><a href=/>Home</a> &gt; <a href=/n>News</a></div>", "<div role=navigation>Skip, go, back</div>", "<ul class=x><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul>"]
AFTER = [
    "<aside><h2>More</h2><p>Other stories, of other harbours, which are longer than this, by far, and tell of nothing.</p></aside>", "<footer>&copy; 2024 The Daily Net, all rights reserved, everywhere.</footer>",
    "<section id='comments'><h2>3 comments</h2><div class=comment><p>I was there, and it was, I must say, not like this at all, not one bit of it, sadly, as they know.</p></div></section>",
    "<form action=/s><label>Search</label><input name=q><select><option>a<option>b</select></form>", "<div class='share-bar'><a href=t>Tweet</a> this, now</div>", "<script>if (a < b) document.write('<p>no, no, no</p>')</script>",
    "<style>p{color:red}</style><noscript>Switch on scripts, please.</noscript><template><p>None of it.</p></template>", "<div style='display:none'>Hidden, words, here</div><div hidden>And here, too</div>", "<div class=newsletter-signup>Subscribe, it is free, and fun.</div>",
    "<div class=related-posts><p>You may also like, we think, the following, very long, list of things.</p></div>"]


@pytest.mark.parametrize("wrap", sorted(WRAPS))
def test_articles_without_what_surrounds_them(wrap):
    want = "\n".join(["Nets", *P])
    body = WRAPS[wrap].format(PARAS)
    for noise in [[], *[[x] for x in BEFORE + AFTER], BEFORE + AFTER]:
        page = "<!DOCTYPE html><html><head><title>T &amp; t</title><meta name=a content='<p>x</p>'></head><body>" + "".join(x for x in noise if x in BEFORE) + body + "".join(x for x in noise if x in AFTER)
        assert main_text(page) == want, noise
        assert main_text(page + "</body></html>") == want, noise


def test_noise_inside_an_article_goes():
    noise = AFTER[-2] + AFTER[1] + AFTER[2] + BEFORE[3] + "<!-- <p>no</p> --><figure><img alt=no><figcaption>A boat.</figcaption></figure>"
    assert main_text(f"<article><h1>Nets</h1><p>{P[0]}</p>{noise}<p>{P[1]}<span class=share>Tweet <span>it</span></span></p></article>") == "\n".join(["Nets", P[0], "A boat.", P[1]])


@pytest.mark.parametrize(("inner", "want"), [
    ("<p>a&nbsp;&amp;amp; b\n\t c&#x41;&eacute;&am &amp", "a &amp; b cAé&am &"), ("<p><b>One.<br><p>Two<p>Three</b>", "One.\nTwo\nThree"), ("x<br>y<div>z</div>w", "x y\nz\nw"),
    ("<ul><li>a, b<li>c<ul><li>d</ul><li>e</ul>", "a, b\nc\nd\ne"), ("<dl><dt>k<dd>v<dt>l<dd>w</dl>", "k\nv\nl\nw"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<p>1 < 2 <3 </ p> end<?x y?><![CDATA[no]]>", "1 < 2 <3 end"),
    ("<p title='a>b' data-x=\"</p>\">q</p>", "q"), ("<P CLASS=Lead>Up</P>", "Up"), ("<pre>a\n  b</pre>", "a b"), ("<p>a</p></div></p></span><p>b", "a\nb"), ("<a href=x><h2>linked</h2></a><p>then not, and on, and on", "linked\nthen not, and on, and on"),
    ("<h2>A<h3>B</h3>c", "A\nB\nc"), ("in<wbr>one<i>word</i>", "inoneword"), ("", ""), ("<p> <p>&nbsp;", "")])
def test_blocks_and_references(inner, want):
    assert main_text(f"<body><nav><a href=n>n</a></nav><article>{inner}</article><footer>f</footer>") == want


@pytest.mark.parametrize("page", ["", None, "   ", "<", "<p", "<!--", "<!-- a", "<script>x", "</", "<a b='", "<nav><a href=x>only</a></nav>", "<!-->", "<html><body></body></html>", "<title>t</title>"])
def test_pages_without_text(page):
    assert main_text(page) in ("", "<")


@pytest.mark.parametrize("piece", ["<div>", "<a ", "<a b=\"", "<a b='>' ", "<!--", "<ul><li>", "</div>", "<table><tr><td>", "<p><b>", "<div class=ad>", "&amp", "<", "<span class=ad>x</span>", "<script>", "<li><div>", ",", "<a href=x>", "<select><option>", "<h1>x"])
def test_hostile_pages_take_linear_time(piece):
    import time

    def took(n):
        start = time.process_time()
        main_text("<body><p>text" + piece * n)
        return time.process_time() - start

    took(100)
    assert took(40_000) < 12 * max(took(10_000), 0.02)


def test_page_query_equals_brute_force(spark, sf_dir):
    from html import unescape

    def plain(html):
        inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        blocks = re.split(r"</?(?:h1|p)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
        return "\n".join(x for x in (" ".join(unescape(b).split()) for b in blocks) if x)

    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r["page_id"]: tuple(r) for r in queries.op13_html_extraction(spark, sf_dir).select("page_id", "url", "text", "n_chars").collect()}
    assert got == {r["page_id"]: (r["page_id"], r["url"], t := plain(r["html"]), len(t)) for r in rows}


def test_pages_of_odd_tables(spark):
    df = spark.createDataFrame([(None, None, None, "x", 1), (1, "u", "", "x", 1), (1, "u", "<p>ä😀</p>", None, 1), (2, None, "<p>" + "word, " * 400_000, "x", 1)], "page_id bigint, url string, html string, text string, n_chars int")
    got = sorted(tuple(r) for r in pagetext.extract_text(df).fillna({"page_id": -1, "url": ""}).collect())
    assert got == [(-1, "", "", 0), (1, "u", "", 0), (1, "u", "ä😀", 2), (2, "", ("word, " * 400_000).strip(), 2_399_999)]
    assert pagetext.extract_text(df.limit(0)).count() == 0
