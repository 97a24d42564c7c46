"""Quality, URLs, HTML and benchmark windows beside plain versions; the pipeline as a whole."""

import os
import re
import zlib

import numpy as np
import pytest
from conftest import empty_like, with_oddities
from pyspark.sql import functions as F

from touchline.llm import decontaminate, html_extract, quality_gam, url_filter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF_DIR = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.01")


# -- quality -------------------------------------------------------------------------------------------------


def test_features(texts):
    import pyarrow as pa

    from touchline.llm.common import byte_chunks

    rows = np.concatenate([quality_gam.features(d, o) for _, _, d, o in byte_chunks(pa.array(texts), 3000)])
    for text, row in zip(texts, rows):
        data = (text or "").encode()
        words = data.split()
        got = dict(zip(quality_gam.NAMES, row))
        n = max(1, len(words))
        assert got["log_words"] == pytest.approx(np.log1p(len(words)))
        assert got["distinct_words"] == pytest.approx(len(set(words)) / n)
        assert got["same_as_before"] == pytest.approx(sum(a == b for a, b in zip(words, words[1:])) / n)
        assert got["mean_word"] == pytest.approx(sum(map(len, words)) / n)
        lines = [x for x in data.split(b"\n") if x]
        assert got["distinct_lines"] == pytest.approx(len(set(lines)) / max(1, len(lines)))
        assert got["longest_line"] == pytest.approx(np.log1p(max(map(len, lines), default=0)))


def test_additive_model_learns_single_features_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (6000, 5))
    logit = 4 * (x[:, 0] > 0.3) - 3 * np.abs(x[:, 1]) + 6 * (x[:, 2] * x[:, 3] > 0) - 3
    y = (rng.uniform(size=6000) < 1 / (1 + np.exp(-logit))).astype(float)
    model = quality_gam.fit(x[:4000], y[:4000])
    assert (2, 3) in model.pairs
    best = ((logit[4000:] > 0) == y[4000:]).mean()
    assert ((model.score(x[4000:]) > 0.5) == y[4000:]).mean() > best - 0.03


def test_classifier(spark, documents):
    labels = documents.select("doc_id", F.lit("x").alias("text"), (F.col("doc_id") % 2).cast("int").alias("quality"))
    labels = labels.union(labels).union(spark.createDataFrame([(None, "", 1), (5, "", None), (8, "", 7)], labels.schema))
    odd = with_oddities(spark, documents)
    rows = quality_gam.classify(odd, labels).collect()
    assert len(rows) == odd.select("doc_id").distinct().count()
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    for few in (labels.limit(0), labels.filter("quality = 1")):
        scores = {r.score for r in quality_gam.classify(documents, few).collect()}
        assert len(scores) == 1 and scores.pop() >= 0.5
    assert quality_gam.classify(empty_like(documents), labels).count() == 0


def plain_score(model, x):
    """Table values of one row, looked up one by one and added."""
    total = model.base
    for value, edges, table in zip(x, model.edges, model.tables):
        total += table[sum(1 for e in edges if e <= value)]
    for (i, j), table in zip(model.pairs, model.pair_tables):
        a, b = (sum(1 for e in model.pair_edges[k] if e <= x[k]) for k in (i, j))
        total += table[a][b]
    return 1 / (1 + np.exp(-total))


def test_scores_beside_table_values_added_per_row(spark, documents):
    """Every document by itself, with its own features, gets the score that it has in a batch."""
    labels = documents.select("doc_id", (F.char_length("text") % 2).alias("quality")).dropna()
    model = quality_gam.train(documents, labels)
    assert sum(len(t) for t in model.tables) > 50 and model.pairs
    rows = quality_gam.score_rows(documents.withColumn("_score", F.lit("x")), model)
    assert rows.columns == [*documents.columns, "_score", "_score_"]
    for r in rows.collect():
        raw = np.frombuffer((r.text or "").encode(), np.uint8)
        (x,) = quality_gam.features(raw, np.array([0, len(raw)]))
        assert r._score_ == pytest.approx(plain_score(model, x))
    assert len({r._score_ for r in rows.collect()}) > 20


def test_labels_of_held_out_rows_are_never_read(spark, documents):
    labels = documents.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))
    one, two = (sorted(map(tuple, quality_gam.classify(documents, x).collect())) for x in (labels, other))
    assert one == two


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables here")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_gam.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = [r.predicted == r.quality for r in rows]
    assert np.mean(right) > 0.9
    assert all(r.predicted for r in rows if r.quality)


# -- urls ----------------------------------------------------------------------------------------------------

URLS = [
    None, "", "no url", "http://Example.COM/en/x?q=/es/", "https://www.example.com/en/", "ftp://a.example.com/en/#x",
    "http://x.net/es/1", "http://net/es/1", "http://xnet/es/", "http://x.net/fr/", "http://x.net/en/", "http://x.net",
    "http://h.org?u=http://a.com/", "x://a.com", "http://a.com/\nb", "://É.com/é", "http://example.com/en", "a://b://c.com/",
    "http://wwww.example.com/en/", "HTTP://M.WWW.EXAMPLE.COM/en/y",
]


def plain_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
    fits = [
        (h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    rule, verdict = max(fits, key=lambda r: len(r[0]), default=(None, None))
    return host, path, rule, verdict


def test_urls(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, "http://a.com/", "", ""), (0, None, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = url_filter.filter_urls(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            host, path, rule, verdict = plain_url(URLS[r.page_id])
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    none = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    assert url_filter.filter_urls(none).first().verdict == "allow"
    assert url_filter.filter_urls(none.limit(0)).count() == 0


def test_urls_learned_from_a_table(spark):
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    made = [(f"{word()}.org", f"/{'casino' if i % 2 else 'news'}/{word()}", "block" if i % 2 else "allow") for i in range(400)]
    labelled = spark.createDataFrame(made[:300], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p, _) in enumerate(made)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, rules=(), labelled=labelled).collect()}
    assert np.mean([got[i] == made[i][2] for i in range(300, 400)]) > 0.95


# -- html ----------------------------------------------------------------------------------------------------

LONG = "Some words of prose, with commas, that go on for a while so that it is text"
PAGES = {
    "": "", "<p>": "", "plain text": "plain text", "<p>a &amp; b&nbsp;&#233;\n\t c": "a & b é c",
    f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href=x>{LONG}</a></ul></nav><div class='ad'>"
    f"{LONG}</div><article><h1>Head</h1><p><b>{LONG}<br><p>Short.<script>var t='</p>'</script></article><footer>{LONG}"
    "</footer></body></html>": f"Head\n{LONG}\nShort.",
    f"<body><div id=menu>{LONG}</div><div class=content><h2>A</h2><p>{LONG}.</p><ul><li>one<li>two</ul><p>{LONG}!</p>"
    f"</div><div class='comments'><p>{LONG}, {LONG}, {LONG}</p></div><form>{LONG}<input></form></body>":
    f"A\n{LONG}.\none\ntwo\n{LONG}!",
    f"<div class=sidebar><p>{LONG}</div><main><p>{LONG}<table><tr><td>1<td>2</table></main><aside>{LONG}</aside>":
    f"{LONG}\n1\n2",
    f"<!-- {LONG} --><article><header><h1>T</h1><p>By me</p></header><p>{LONG}</p><section class=related><p>{LONG}"
    f"</section></article>": f"T\n{LONG}",
    f"<article><p>a</p></article><p>{LONG}": None,
}


def test_main_text():
    for html, text in PAGES.items():
        if text is not None:
            assert html_extract.main_text(html) == text
        else:
            assert html_extract.main_text(html)


P = f"<p>{LONG}.</p>"
PROBES = {
    # Names that only hold a marked word.
    f"<body><div class='content no-sidebar'>{P}{P}</div>": f"{LONG}.\n{LONG}.",
    f"<body><div class='layout-with-sidebar'><article><h1 class=page-header>T</h1>{P}</article></div>": f"T\n{LONG}.",
    f"<body><div><p class='notice-period'>{LONG}<section class='market-share'>{P}</section></div>": f"{LONG}\n{LONG}.",
    # Names made of marked words and places.
    f"<body><div class='site-footer'>{P}</div><div id=leftSidebar2>{P}</div><div class='ad-slot-300x250'>{P}</div><div>{P}</div>"
    f"<div class='related posts-list'>{P}</div><div role=navigation>{P}</div>": f"{LONG}.",
    # A marked element that holds the article, and one that is all there is; but not comments.
    f"<body><div class='banner'><h1>T</h1>{P * 5}</div><div>{P}</div>": "T\n" + "\n".join([f"{LONG}."] * 5) + f"\n{LONG}.",
    f"<body><div class='widget'>{P}</div>": f"{LONG}.", f"<body><article><p>Short.</article><div class=comments><article>{P * 9}</article></div>": "Short.",
    f"<body><div class=ad>{P * 3}</div><article><p>Short.</article>": "Short.",
    # What stands beside the best container.
    f"<body><div><div>{P * 6}</div><div><h2>B</h2><p>Two hundred, or so.</div><ul><li>one<li>two</ul>straight in it"
    f"<table><tr><td>1</table><figure><figcaption>f</figcaption></figure><ul><li><a href=x>{LONG}</a></ul></div>":
    "\n".join([f"{LONG}."] * 6) + "\nB\nTwo hundred, or so.\none\ntwo\nstraight in it\n1\nf",
    # Further up: paragraphs and headings, not lists of links nor short lines.
    f"<body><h1>T</h1><div>by me</div><div><div><div>{P * 4}</div></div></div><div><div>{P}</div></div><div><a href=x>{LONG}</a></div>":
    "T\n" + "\n".join([f"{LONG}."] * 5),
    # Articles that stand beside the best one belong to it; lists of links and empty ones do not.
    f"<body><main><article>{P}{P}</article><article><h2>B</h2>{P}</article><article><a href=x>{LONG}</a></article><p>x</p></main>":
    f"{LONG}.\n{LONG}.\nB\n{LONG}.",
}


@pytest.mark.parametrize("html", PROBES)
def test_no_article_text_is_dropped(html):
    assert html_extract.main_text(html) == PROBES[html]


def plain_scores(tree):
    """Points of all nodes from the definition, node by node."""
    def text(node, links=False, inside=False):
        if node.away:
            return 0
        inside = inside or node.tag == "a"
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str)) if inside or not links else 0
        return own + sum(text(c, links, inside) for c in node.children if not isinstance(c, str))

    def strings(node):
        for c in node.children:
            if isinstance(c, str):
                yield c
            elif c.tag not in html_extract._BLOCK and not c.away:
                yield from strings(c)

    points = {}
    for node in tree.nodes:
        if node.away or node.tag not in html_extract._PARAGRAPH:
            continue
        own = list(strings(node))
        length = sum(len(x.strip()) for x in own)
        if length >= 25:
            score = (1 + sum(x.count(",") for x in own) + min(length / 100, 3)) * (1 - text(node, True) / text(node))
            if node.tag not in ("p", "pre", "blockquote", "li", "td", "dd"):
                points[node] = points.get(node, 0.0) + score
            for step in range(1, 5):
                node = node.parent
                if node is None:
                    break
                points[node] = points.get(node, 0.0) + score / step
    return points, text


def test_scores_of_random_trees():
    import random

    rng = random.Random(9)

    def grow(depth):
        tag = rng.choice(["div", "div", "section", "ul", "li", "p", "a", "b", "td", "h2", "aside", "main", "article"])
        inner = "".join(rng.choice([LONG, "short, ", "", f"{LONG},{LONG}"]) if depth == 0 or rng.random() < 0.4 else grow(depth - 1)
                        for _ in range(rng.randint(1, 4)))
        name = rng.choice(["", "", "", " class=sidebar", " class=no-ad", " id=comments"])
        return f"<{tag}{name}>{inner}</{tag}>"

    scored = 0
    for _ in range(300):
        tree = html_extract._Tree()
        tree.feed(f"<body>{grow(5)}{grow(4)}</body>")
        tree.close()
        html_extract._drop_marked(tree)
        html_extract._scores(tree)
        points, text = plain_scores(tree)
        for node in tree.nodes:
            assert node.points == pytest.approx(points.get(node, 0.0))
            assert (node.text, node.links) == (text(node), text(node, True)) or node.away or any(
                n.tag == "a" for n in above(node))
            scored += node.points > 0
    assert scored > 500


def above(node):
    while node.parent is not None:
        node = node.parent
        yield node


def test_broken_markup_takes_linear_time():
    import time

    for part in ("<b>", "<p><b>", "</x>", "<li>", "<div>", "<td>", "&", "<b></i>", "<a href='"):
        html_extract.main_text(part * 100)
        times = []
        for n in (2_000, 16_000):
            start = time.process_time()
            html_extract.main_text(part * n + "</div>")
            times.append(time.process_time() - start)
        assert times[1] < 16 * max(times[0], 0.02), part


def test_pages(spark):
    rows = [(i, f"u{i}", h, "x") for i, h in enumerate(PAGES)] + [(None, None, None, "x"), (0, "u", "<p>b", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract_pages(pages).collect()
    assert len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got)
    assert {(r.page_id, r.text) for r in got if r.url is None or r.url == "u"} == {(None, ""), (0, "b")}
    assert html_extract.extract_pages(empty_like(pages)).count() == 0


# -- benchmark -----------------------------------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_windows(pairs, items):
    windows = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    out = {}
    for doc_id, text in pairs:
        words = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                ids = windows.get(tuple(words[i : i + n]))
                if ids:
                    hit |= set(range(i, i + n))
                    found |= ids
        out[doc_id] = (len(words), len(hit), len(found), sorted(map(str, found)))
    return out


@pytest.mark.parametrize("bits", [decontaminate.FILTER_BITS, 8])
def test_windows(spark, documents, texts, bits):
    import hashlib

    words = WORD.findall(texts[20].translate(LOWER))
    items = [(1, " ".join(words[:30])), (2, "... " + " -".join(words[5:15]) + "!"), (11, " ".join(words[3:12])), (4, None),
             (5, ""), (6, "x" * 100), (7, texts[30].upper()), (8, " ".join(words[:30])), (9, words[0]), (10, texts[64][:300])]
    benchmark = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, hit string")
    odd = with_oddities(spark, documents)
    pairs = {r.doc_id: r.text for r in odd.orderBy(F.col("text").asc_nulls_first()).collect()}
    expected = plain_windows(pairs.items(), items)
    got = decontaminate.decontaminate(odd, benchmark, bits).collect()
    assert len(got) == len(pairs)
    for r in got:
        n_words, n_hit, n_items, ids = expected[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n_words, n_hit, n_items, n_hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert sum(r.contaminated for r in got) > 3
    clean = {r.doc_id for r in decontaminate.clean_rows(documents, benchmark, bits).collect()}
    assert clean == {d for d, v in plain_windows([(r.doc_id, r.text) for r in documents.collect()], items).items() if not v[1]}
    assert decontaminate.decontaminate(documents, benchmark.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.decontaminate(empty_like(documents), benchmark).count() == 0


def test_clean_rows_keeps_columns_and_repeated_rows(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    rows = [(1, passage, "a", 1), (1, "clean", "b", 2), (1, "clean", "b", 2), (None, None, "c", 3), (2, f"so {passage} so", "d", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _text_md5 string, digest int")
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = decontaminate.clean_rows(df, benchmark)
    assert kept.columns == df.columns and sorted(map(str, kept.collect())) == sorted(map(str, df.filter("digest in (2, 3)").collect()))
    assert decontaminate.clean_rows(df, benchmark.limit(0)).count() == 5 and decontaminate.clean_rows(df.limit(0), benchmark).count() == 0


def test_filter_lets_all_known_pass(spark):
    rng = np.random.default_rng(3)
    prints = rng.integers(-(2**63), 2**63 - 1, 5000)
    windows = spark.createDataFrame([(int(p),) for p in prints], "print long")
    others = rng.integers(0, 2**63, 100_000).astype(np.uint64)
    for limit, most in ((decontaminate.FILTER_BITS, 0.01), (1 << 15, 0.3), (8, 0.3)):
        known = decontaminate._filter(windows, limit)
        assert len(known.passing(prints.view(np.uint64))) == 5000
        assert len(known.passing(others)) < most * len(others)


# -- pipeline ------------------------------------------------------------------------------------------------


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables here")
def test_pipeline(spark):
    import corpus_pipeline
    from test_dedup import plain_least, plain_lines

    from touchline.llm import sentencepiece_codec

    sf_dir = SF_DIR.replace("sf0.01", "sf0.001")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in quality_gam.classify(docs, labels).filter("predicted = 1").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    marked = plain_lines(texts.items())
    kept = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs.filter(F.col("doc_id").isin(*good)), sf_dir).collect()}
    assert {d: v[2] for d, v in marked.items()} == {
        d: __import__("hashlib").sha256((t or "").encode()).hexdigest() for d, t in kept.items()}
    least = set(plain_least(kept.items()))
    kept = {d: t for d, t in kept.items() if d in least}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {d: t for d, t in kept.items() if not plain_windows([(d, t)], items)[d][1]}
    import public_tokenizers

    model = sentencepiece_codec.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == {d: model.encode(t or "") for d, t in kept.items()}
    assert 0 < len(got) < docs.count()
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, sf_dir)
        assert out.count() == 0
        if name != "pieces":
            assert out.columns == docs.columns


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables here")
def test_odd_rows_through_the_stages(spark):
    """Null ids and texts, repeated ids and rows, and other columns go through every stage."""
    import corpus_pipeline

    sf_dir = SF_DIR.replace("sf0.01", "sf0.001")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(40)
    odd = spark.createDataFrame(
        [(None, "no id", "en", "s", 5), (7, None, None, None, None), (7, "another text of id seven", "en", "s", 24), (8, "", "en", "s", 0),
         (8, "", "en", "s", 0), (10**12, None, "en", None, None)], docs.schema)
    rows = docs.union(odd).withColumns({"_dropped": F.lit(1), "_score": F.lit("x"), "id": F.lit(2), "key": F.lit("k"), "_text_md5": F.lit(0)})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, sf_dir)
        got = out.collect()
        assert got and len(got) <= rows.count()
        if name != "pieces":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        if name == "lines":
            assert len(got) == rows.count() and sum(r.text is None for r in got) == 2
        if name in ("near_copies", "pieces"):
            assert len({r.doc_id for r in got}) == len(got)
