"""op5, op7, op8, op9 and the pipeline: brute force, SQL and odd rows."""

import html
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import graph, html_text, line_dedup, mixing, queries, simhash
from shelfline.llm.shared import cut

SF = "/root/testdata/sf0.001"


def _duck(sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return con.execute(sql).df()


def _same(a, b, key):
    a, b = (x.sort_values(key).reset_index(drop=True)[sorted(x.columns)] for x in (a, b))
    assert a.dtypes.index.equals(b.dtypes.index) and len(a) == len(b)
    for c in a.columns:
        x, y = (f[c].astype(object).where(f[c].notna(), None).tolist() for f in (a, b))
        assert x == y, c


def test_fingerprint_is_xxhash64_majority(spark):
    text = "One two  three\tfour FIVE"
    h = [r[0] for r in spark.sql("select xxhash64(x) from values ('one two three'),('two three four'),('three four five') t(x)").collect()]
    bits = [sum((v >> b) & 1 for v in h) * 2 > 3 for b in range(64)]
    assert simhash.fingerprint(text, 3) & ((1 << 64) - 1) == sum(1 << b for b in range(64) if bits[b])
    assert simhash.fingerprint(None, 3) == simhash.fingerprint(" \n", 3) == 0
    assert simhash.fingerprint("A b", 3) == spark.sql("select xxhash64('a b')").first()[0]
    long = " ".join(f"w{i}" for i in range(300))
    w = long.split()
    h = spark.createDataFrame([(" ".join(w[i:i + 3]),) for i in range(298)], "s string").select(F.xxhash64("s")).collect()
    assert simhash.fingerprint(long, 3) & ((1 << 64) - 1) == sum(
        1 << b for b in range(64) if 2 * sum((v[0] >> b) & 1 for v in h) > 298)


@pytest.mark.parametrize("bits", [2, 3])
def test_ball_hashing_keeps_the_components(spark, bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = [int(x) for x in base]
    for x in base[:30]:  # chains of near fingerprints, some just out of reach
        y = int(x)
        for _ in range(8):
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                y ^= 1 << int(b)
            fps.append(y)
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    a = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= bits
    label = np.arange(len(a))
    while not np.array_equal(new := np.array([label[n].min() for n in near]), label):
        label = new
    df = cut(spark.createDataFrame([(f,) for f in fps], "fp bigint"))
    root = {r.node: r.root for r in graph.components(simhash.similar_edges(df, len(fps), bits)).collect()}
    assert [root.get(f, f) for f in fps] == [fps[i] for i in label]


def test_components_of_a_path_and_a_hub(spark):
    rows = [(i, i + 1) for i in range(60)] + [(5000, 5000 + i) for i in range(1, 400)] + [(9, 9)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(rows, "u bigint, v bigint").repartition(7)).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {5000 + i: 5000 for i in range(1, 400)}


def test_near_duplicates_odd_rows(spark, odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    comp = {}
    for r in got:
        comp.setdefault(r.doc_id, set()).add(r.component_id)
    assert comp[1] == comp[2] == {1} and comp[3] == comp[4] == comp[8] == {3} and comp[None] == {None}
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 5, 6, 9]
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0
    twice = odd_docs.filter("doc_id = 1").unionByName(odd_docs.filter("doc_id = 1"))
    assert simhash.keep_one(twice).count() == 1


def test_keep_one_of_each_group_where_ids_are_null_or_repeated(spark):
    text = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abcdefg"}
    rows = [(None, text["a"], "x"), (None, text["b"], "y"), (None, text["b"], "z"),  # two groups without an id
            (None, text["c"], "x"), (7, text["c"], "x"),                             # an id goes before a null
            (5, text["d"], "x"), (5, text["e"], "x"),                                # one id, two texts
            (1, text["f"], "x"), (6, text["f"], "x"), (6, text["g"], "x"), (8, text["g"], "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    got = sorted(((r.text[0], r.doc_id, r.source) for r in simhash.keep_one(docs).collect()))
    assert got == [("a", None, "x"), ("b", None, "y"), ("c", 7, "x"), ("d", 5, "x"), ("e", 5, "x"),
                   ("f", 1, "x"), ("g", 6, "x")]


@pytest.mark.parametrize("sf", [SF])
def test_registered_queries_against_sql(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    for name, sql in queries.ORACLES.items():
        key = (["query_id", "rank"] if "top_k" in name else
               ["anchor_id", "positive_id", "rank"] if "negatives" in name else ["doc_id"])
        _same(queries.QUERIES[name](spark, sf).toPandas(), _duck(sql, documents=docs, embeddings=vectors), key)


def test_mix_odd_rows(spark, odd_docs, no_docs):
    got = mixing.sizes(odd_docs).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken")).toPandas()
    want = _duck(mixing.ORACLE, documents=odd_docs.select("doc_id", "text", "source").toArrow())
    _same(got, want, ["doc_id", "size"])
    assert (got.taken <= 3 * got["size"]).all()
    taken = mixing.take(odd_docs)
    assert taken.columns == odd_docs.columns
    assert mixing.sizes(no_docs).count() == 0 and mixing.take(no_docs).count() == 0


def test_mix_reaches_targets_through_buckets(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "s" + "abcd"[int(k)], "x " * int(n)) for i, (k, n) in enumerate(
        zip(rng.choice(4, 5000, p=[.6, .2, .1, .1]), rng.integers(1, 60, 5000)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(5)
    runs = [mixing.sizes(docs.repartition(k), bucket_rows=b).toPandas().sort_values("doc_id").reset_index(drop=True)
            for k, b in ((3, 100), (7, 100))]
    assert runs[0].equals(runs[1])
    x = runs[0].merge(docs.select("doc_id", "source").toPandas(), on="doc_id")
    x["taken"] = x.mix_size * x.mix_copies
    per = x.groupby("source").agg(target=("mix_target", "first"), taken=("taken", "sum"), n=("mix_source_size", "first"))
    assert abs(per.target.sum() - per.n.sum()) < 1e-6 * per.n.sum()
    assert (abs(per.target - per.taken) <= 5).all()
    assert (per.target <= 3 * per.n).all()


def test_line_dedup_odd_rows(spark, odd_docs, no_docs):
    lines = [(i, f"header line\nonly {i} here\n\nfooter  \nfooter", "en", "site" if i % 2 else None, 1) for i in range(30, 60)]
    whole = [(i, "the same page", "en", "copies", 1) for i in range(70, 76)]
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(
        lines + whole, "doc_id bigint, text string, lang string, source string, n_chars bigint")).withColumn("a", F.lit(1))
    got = line_dedup.drop_boilerplate(docs, counts=True).select("doc_id", "text", "lines_total", "lines_dropped")
    want = _duck(queries.ORACLES["op9_line_dedup"], documents=docs.select("doc_id", "text", "source").toArrow())
    _same(got.toPandas(), want, ["doc_id", "text"])
    by = {r.doc_id: r for r in got.collect()}
    assert by[31].text == "only 31 here\n" and by[31].lines_dropped == 3
    assert by[70].text == "the same page"  # a copied page is left to the near-duplicate stage
    assert by[3].text is None
    assert line_dedup.drop_boilerplate(docs).columns == docs.columns
    assert line_dedup.drop_boilerplate(no_docs, counts=True).count() == 0


def test_line_dedup_drops_whatever_share_and_counts_copies_once(spark):
    menu = "\n".join(f"a long entry number {k} of the site's menu" for k in range(10))
    rows = [(i, f"{menu}\nown {i}", "s") for i in range(20)] + [(20, menu, "s")]
    rows += [(100 + i, "copied line one\ncopied line two", "s") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "9 as lines_total", "8 as pages")
    got = line_dedup.drop_boilerplate(docs, counts=True)
    assert sorted(got.columns) == sorted(["doc_id", "text", "source", "pages", "lines_total", "lines_dropped"])
    by = {r.doc_id: (r.text, r.lines_total, r.lines_dropped) for r in got.collect()}
    assert all(by[i] == (f"own {i}", 11, 10) for i in range(20)) and by[20] == ("", 10, 10)
    assert all(by[100 + i] == ("copied line one\ncopied line two", 2, 0) for i in range(50))
    want = _duck(queries.ORACLES["op9_line_dedup"], documents=docs.select("doc_id", "text", "source").toArrow())
    _same(got.select("doc_id", "text", "lines_total", "lines_dropped").toPandas(), want, ["doc_id"])


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body class="has-sidebar">
<header>Site name</header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad">Buy</div>{body}
<div id="comments"><article><p>nice post</p></article></div><footer>&copy; site</footer>"""


def test_main_text(spark):
    art = "<article><h1>Head &amp; &lt;tail&gt;</h1><p><b>One\n  two<br><p>three &#233;</p><aside>no</aside><form>no<input></form><p>a < b</article>"
    plain = "<div><p>Unique words of page {i} that stand{i} on it alone{i} and nowhere else</p><p>{rep}</p></div>"
    rep = "please read our terms of use before you go on with this site"
    rows = [(0, "http://a.x/1", PAGE.format(body=art)), (1, "http://a.x/2", None), (2, None, ""), (0, "http://a.x/1", PAGE.format(body=art))]
    rows += [(10 + i, f"https://b.y/{i}?q", PAGE.format(body=plain.format(i=i, rep=rep))) for i in range(8)]
    rows += [(30 + i, f"https://c.z/{i}", PAGE.format(body=f"<article><p>{rep}</p><p>page {i}</p></article>")) for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("c0", F.lit("clash"))
    got = html_text.main_text(pages)
    assert got.columns == ["page_id", "url", "c0", "text"]
    by = {r.page_id: r.text for r in got.collect()}
    assert by[0] == "Head & <tail>\nOne two\nthree é\na < b" and by[1] == by[2] == ""
    assert got.count() == len(rows)
    for i in range(8):
        assert by[10 + i] == f"Unique words of page {i} that stand{i} on it alone{i} and nowhere else"  # the run is boilerplate
        assert by[30 + i] == f"{rep}\npage {i}"  # articles may share passages
    assert html_text.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("outer", [
    'article style="overflow:hidden"', "article aria-hidden='false'", "div style='overflow: hidden'", "div data-hidden",
    'div class="layout has-sidebar"', 'div title="hidden class=ad"', "div data-role=navigation"])
def test_blocks_take_only_attributes_of_their_own_name(outer):
    tag = outer.split()[0]
    page = f'<body style="overflow-x:hidden"><{outer}><p>The text</p></{tag}>'
    assert [t for t, _ in html_text.blocks(page)] == ["The text"]


@pytest.mark.parametrize("outer", [
    "div hidden", 'div id=x hidden=""', "div HIDDEN class=a", 'div class="left sidebar"', "div role='navigation'", "div id=comments"])
def test_blocks_leave_out_what_names_itself(outer):
    assert [t for t, _ in html_text.blocks(f"<{outer}><p>Not this</p></div><p>The text</p>")] == ["The text"]


@pytest.mark.parametrize("chunk_bytes", [8 << 20, 300])
def test_main_text_runs_span_short_blocks(spark, chunk_bytes):
    menu = "".join(f"<div>{x}</div>" for x in ("Home", "Our shop", "News", "About us", "Contact", "Log in"))
    body = menu + "<p>Own{i} words{i} of{i} page{i}</p><p>Short</p><p>other{i}</p>"
    rows = [(i, f"https://b.y/{i}", body.format(i=i)) for i in range(12)] + [(50, "https://b.y/50", "<p>Home</p><p>Our shop</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(pages, chunk_bytes=chunk_bytes).collect()}
    assert got == {i: f"Own{i} words{i} of{i} page{i}\nShort\nother{i}" for i in range(12)} | {50: "Home\nOur shop"}


@pytest.mark.parametrize("parts", [1, 5])
def test_main_text_counts_over_a_host_of_many_chunks(spark, parts):
    rep = "please read our terms of use before you go on with this site"
    two = "a longer notice that stands on one page and its copies and on one other page"
    body = "<p>Words of page{i} own{i} alone{i} and nowhere{i} else</p><p>{rep}</p>"
    rows = [(i, f"https://b.y/{i}", body.format(i=i, rep=rep if i % 9 == 0 else two if i == 1 else f"tail{i}"))
            for i in range(60)]
    rows += [(100 + i, f"https://b.y/c{i}", f"<p>{two} copied</p>") for i in range(12)]  # copies count once
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(parts)
    whole = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    got = {r.page_id: r.text for r in html_text.main_text(pages, chunk_bytes=150).collect()}
    assert got == whole and len(got) == len(rows)
    assert got[9] == "Words of page9 own9 alone9 and nowhere9 else"
    assert got[1].endswith(two) and all(got[100 + i] == f"{two} copied" for i in range(12))


@pytest.mark.parametrize("page, want", [
    ("<script src=/a/>var x=1;</script><p>Main</p>", ["Main"]),
    ("<script/>var x=1;</script><p>Main</p>", ["Main"]),
    ('<div class="sidebar"><article>Teaser</article></div><article>Main</article>', ["Main"]),
    ('<div class="sidebar"><article>Teaser</article></div><p>Main</p>', ["Main"]),
    ('<form id="aspnetForm"><article>Main</article><input></form>', ["Main"]),
    ("<form><p>Your name</p></form><p>Main</p>", ["Main"]),
    ("<form><p>Your name</p></form>", []),
    ('<div class="widget"><p>The whole text</p></div>', ["The whole text"]),
    ('<div class="widget"><article>Main</article></div><p>Skip to content</p>', ["Main"]),
    ('<div class="widget">Side</div><p>Main</p>', ["Main"]),
    ("<a href=/x/>Read</a><p>Main</p>", ["Read", "Main"]),
    ('<div class="main-content-with-ads"><p>Main</p></div>', ["Main"]),
    *[(f'<article><p>Main</p><div class="{c}">Not this</div></article>', ["Main"])
      for c in ("cookie-banner", "site-footer", "ad-slot", "comment-list", "post_share", "related-posts", "notice")]])
def test_blocks_by_the_rules_of_html(page, want):
    assert [t for t, _ in html_text.blocks(page)] == want


def _extracted(pages, run_words=8):
    """The whole query from its definition: every run of every distinct page counted by hand."""
    scanned = [(i, host, html_, html_text.blocks(html_)) for i, host, html_ in pages]
    holders, hosts = {}, {}
    for _, host, page, found in scanned:
        hosts.setdefault(host, set()).add(page)
        words = [w.lower() for t, _ in found for w in t.split(" ")]
        for k in range(len(words) - run_words + 1):
            holders.setdefault((host, tuple(words[k:k + run_words])), set()).add(page)
    out = {}
    for i, host, _, found in scanned:
        split = [t.split(" ") for t, _ in found]
        block = [b for b, ws in enumerate(split) for _ in ws]
        words = [w.lower() for ws in split for w in ws]
        need = [3 if place == html_text.FREE else max(20, len(hosts[host]) // 2 + 1) for _, place in found]
        whole, inside = set(), set()
        for k in range(len(words) - run_words + 1):
            n = len(holders[host, tuple(words[k:k + run_words])])
            for j in range(k, k + run_words):
                if n >= need[block[j]]:
                    whole.add(j)
                    if block[k] == block[k + run_words - 1]:
                        inside.add(j)
        kept, at = [], 0
        for b, ws in enumerate(split):
            span = range(at, at + len(ws))
            at += len(ws)
            if not all(j in whole for j in span):
                left = [w for w, j in zip(ws, span) if j not in inside]
                kept += [" ".join(left)] * bool(left)
        out[i] = "\n".join(kept)
    return out


@pytest.mark.parametrize("chunk_bytes", [2 << 20, 500])
def test_main_text_against_brute_force(spark, chunk_bytes):
    rng = np.random.default_rng(11)
    notices = [" ".join(rng.choice(list("abcdefgh"), 12)) for _ in range(6)]
    rows = []
    for i in range(140):
        host = ["one.x", "two.y"][i % 3 == 0]
        own = [" ".join(f"w{x}" for x in rng.integers(0, 400, rng.integers(1, 25))) for _ in range(rng.integers(1, 5))]
        for k in (0, int(rng.integers(1, 6))):  # alone, or behind words of the page
            own.insert(int(rng.integers(0, len(own) + 1)), notices[k] if rng.random() < 0.5 else f"own {i} {notices[k]} end{i}")
        body = "".join(f"<p>{t}</p>" for t in own)
        body = f"<article>{body}</article>" if i % 2 else body
        rows.append((i, host, f"<body>{body}</body>"))
    rows += [(200 + k, "one.x", rows[1][2]) for k in range(30)]
    pages = spark.createDataFrame([(i, f"http://{h}/{i}", p) for i, h, p in rows], "page_id bigint, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_text.main_text(pages, chunk_bytes=chunk_bytes).collect()}
    want = _extracted(rows)
    assert got == want
    plain = {i: "\n".join(t for t, _ in html_text.blocks(p)) for i, _, p in rows}
    changed = [i for i in plain if plain[i] != got[i]]
    assert len(changed) > 60  # by the suffix arrays alone
    assert any(i % 2 for i in changed if i < 200) and any(f"own {i} end{i}" in got[i] for i in changed)


def test_covered_against_brute_force():
    rng = np.random.default_rng(0)
    tokens, page, at = [], [], 0
    for p in range(12):
        for _ in range(3):
            for t in rng.integers(0, 2, rng.integers(3, 20)):
                tokens.append(int(t)); page.append(p)
            tokens.append(-1 - at); page.append(-1); at += 1
    tokens, page = np.array(tokens), np.array(page)
    k, want = 5, np.zeros(len(tokens), int)
    seen = {}
    for i in range(len(tokens) - k + 1):
        if (page[i:i + k] >= 0).all():
            seen.setdefault(tuple(tokens[i:i + k]), set()).add(page[i])
    for i in range(len(tokens) - k + 1):
        if (page[i:i + k] >= 0).all():
            want[i:i + k] = np.maximum(want[i:i + k], len(seen[tuple(tokens[i:i + k])]))
    assert np.array_equal(html_text.covered(tokens, page, k), want)


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    prior, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, prior, SF)
        out.write.parquet(path := str(tmp_path / name))
        kept[name] = spark.read.parquet(path)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        prior = kept[name]
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in kept.items()}
    assert ids["toxicity"] == ids["line_dedup"] and ids["simhash_near_dedup"] <= ids["line_dedup"]
    groups = simhash.near_duplicates(kept["line_dedup"]).toPandas()
    assert ids["simhash_near_dedup"] == set(groups.component_id)
    mixed = mixing.mix(kept["simhash_near_dedup"]).toPandas()
    assert kept["source_mix"].count() == mixed.mix_copies.sum() == kept["sentencepiece"].count()
    assert kept["sentencepiece"].filter("roundtrip and n_differ = 0").count() == mixed.mix_copies.sum()


def test_pipeline_clashing_columns(spark, odd_docs, tmp_path):
    """Columns named like those of a stage, and a map column, pass through."""
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(folder + "/labels.parquet")
    docs = odd_docs.selectExpr("*", "1 as n_tokens", "array(2) as token_ids", "3 as mix_copies", "4 as mix_size", "5 as score",
                               "6 as lines_total", "7 as p_toxic", "map('k', doc_id) as tags", "8 as fp", "9 as root")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, folder))
        if name != "sentencepiece":
            assert docs.columns == columns, name
            assert {r.mix_copies for r in docs.select("mix_copies").collect()} == {3}
    assert docs.columns[-4:] == ["token_ids", "n_tokens", "n_differ", "roundtrip"] and "tags" in docs.columns
    assert docs.count() > 0


def test_pipeline_odd_rows(spark, odd_docs, no_docs, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(folder + "/labels.parquet")
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = cut(stage(spark, docs, folder))
    assert docs.count() == 0 and html.unescape("&amp;") == "&" and os.path.isdir(folder)
