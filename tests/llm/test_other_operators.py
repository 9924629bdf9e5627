"""Pages, embeddings, the pipeline and the registry."""

import random

import numpy as np
import pytest


def page(title, paragraphs, extra="", article=True):
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
    main = f"<article>{body}</article>" if article else f"<div class='content'><div class='text'>{body}</div></div>"
    return (f"<!DOCTYPE html><html><head><title>{title}</title><script>var t='</p><p>x';</script></head><body><header><a href=/>Site name</a></header>"
            f"<nav><ul><li>Home<li>News</ul></nav><div class='cookie-notice'>We use cookies</div><div class=ad>Buy <b>now</b></div>"
            f"<div class='promo2'>Always the same slogan of this site</div>{main}{extra}<aside>Related</aside><form><p>Search</p></form>"
            f"<div id='comments'><article class='comment'><p>First! A very long reader comment that says nothing at all, again and again and again</p></article></div><footer>&copy; 2024</footer></body></html>")


@pytest.mark.parametrize("article", [True, False])
def test_wrapper_induction(article):
    from panelkit.llm.htmlx import extract_group

    pages = [page(f"Title {k}", [f"Paragraph {k} &amp; one<br>more  text that is long enough to be the content", f"second &eacute; {k} with a good deal of words", "The same legal line on each page"], article=article) for k in range(8)]
    out = extract_group(pages)
    for k, text in enumerate(out):
        lines = text.split("\n")
        assert lines[:3] == [f"Title {k}", f"Paragraph {k} & one more text that is long enough to be the content", f"second é {k} with a good deal of words"]
        assert "slogan" not in text and "comment" not in text and "cookies" not in text and "Home" not in text
    if article:
        assert all(t.endswith("The same legal line on each page") for t in out)


def test_extraction_of_awkward_pages(spark):
    from panelkit.llm.htmlx import extract

    rows = [(1, "http://a.example/1", None), (2, "http://a.example/2", ""), (3, None, "<p>plain text <b>bold<br><p>next"), (4, "nonsense", "no tags &lt;here&gt;"),
            (5, "http://a.example/3", "<article><p>unclosed <i>tag<p>two < three</article>"), (5, "http://a.example/3", "<article><p>unclosed <i>tag<p>two < three</article>"),
            (6, "http://a.example/4", "<article>" + "<p>x y</p>" * 20_000 + "</article>"), (7, "http://a.example/5", "<div><article><p>in</p><!-- <p>out</p> --><script>p('</article>')</script><p>in&nbsp;too</p></article>")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    out = sorted((r.page_id, r.text) for r in extract(df).collect())
    assert out[:2] == [(1, ""), (2, "")] and out[2] == (3, "plain text bold\nnext") and out[3] == (4, "no tags <here>")
    assert out[4] == out[5] == (5, "unclosed tag\ntwo < three") and out[6][1].count("\n") == 19_999 and out[7] == (7, "in\nin too")
    assert extract(df.limit(0)).count() == 0


def test_no_page_of_a_large_host_is_left_without_template(spark):
    from panelkit.llm.htmlx import extract

    rows = [(k, f"http://{host}.example/{k}", page(f"Title {k}", [f"Paragraph {k} of the page, long enough to be the content"], article=False))
            for host, pages in (("a", range(129)), ("b", range(200, 205)), ("c", range(300, 305))) for k in pages]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    texts = []
    try:
        for n in ("3", "60"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            texts.append({r.page_id: r.text for r in extract(df).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert texts[0] == texts[1] and len(texts[0]) == len(rows)
    assert not any("slogan" in t for t in texts[0].values())


@pytest.mark.parametrize("tag", ["div", "span", "font", "section"])
def test_deeply_nested_pages(tag):
    from panelkit.llm.htmlx import extract_group

    deep = [f"<article><h1>Title {k}</h1>" + f"<{tag}>word{k} " * 5000 + "</article>" for k in range(5)]
    bare = [f"<h1>Title {k}</h1>" + f"<{tag}>" * 5000 + f"word{k} " * 5000 for k in range(5)]
    for pages in (deep, bare, deep[:2]):
        for k, text in enumerate(extract_group(pages)):
            assert text.split().count(f"word{k}") == 5000


def test_content_root_follows_the_varying_text():
    from panelkit.llm.htmlx import extract_group

    words = lambda k, what: f"{what} {k} with words that differ on each page, such as w{k * 7} and v{k * 11}"
    menu = "<ul><li>Share this page</li><li>Print this page</li></ul>"
    # a mark on what holds the article
    for wrap in ("<div class='has-sidebar'>", "<div class='content-sidebar-wrap'>", "<div id='search-page'>", "<form class='aspnet'>"):
        out = extract_group([f"<header>Site</header>{wrap}<article><h1>T {k}</h1><p>{words(k, 'Body')}</p>{menu}</article><div class='sidebar'><p>Links {k}</p></div></div><footer>Foot</footer>" for k in range(8)])
        assert [t.split("\n") for t in out] == [[f"T {k}", words(k, "Body")] for k in range(8)]
    # an article tag round a small notice is not the content
    out = extract_group([f"<article class=box><p>Always the same box</p></article><div class=text><p>{words(k, 'One')}</p><p>{words(k, 'Two')}</p></div>" for k in range(8)])
    assert out == [f"{words(k, 'One')}\n{words(k, 'Two')}" for k in range(8)]
    # several of a kind
    out = extract_group(["<div id=list>" + "".join(f"<article><p>{words(k, w)}</p></article>" for w in ("One", "Two", "Three and much more than the others, as it goes on")) + "</div>" for k in range(8)])
    assert all(t.count("\n") == 2 and "One" in t and "Two" in t for t in out)
    # the only page of its host
    assert words(1, "Body") in extract_group([f"<div class='has-sidebar'><article><p>{words(1, 'Body')}</p></article></div>"])[0]


def test_tree_matching_is_the_largest():
    from panelkit.llm.htmlx import Slot, match, parse

    a, b = (Slot([parse(h)]) for h in ("<div><p>x<ul><li>1</ul><section></section></div>", "<div><ul><li>1<li>2</ul><p>y<section></section></div>"))
    assert match(a, b, {}) == 5  # html, div, ul, li, section


def test_lattice_decoding_is_nearest():
    from panelkit.llm.lattice import ROOTS, decode, neighbours

    assert len(ROOTS) == 240 and {int((r * r).sum()) for r in ROOTS} == {8}
    x = np.random.default_rng(0).normal(0, 1.3, (400, 8))
    c = decode(x)
    assert ((c.sum(1) % 4 == 0) & ((c % 2 == 0).all(1) | (c % 2 != 0).all(1))).all()
    d = ((x - c / 2) ** 2).sum(1)
    assert (d[:, None] <= ((x[:, None] - (c[:, None] + ROOTS) / 2) ** 2).sum(2) + 1e-9).all()
    near = neighbours(x, c, 3)
    assert (np.sort(((x[:, None] - (c[:, None] + ROOTS) / 2) ** 2).sum(2), 1)[:, 2] + 1e-9 >= ((x[:, None] - near / 2) ** 2).sum(2).max(1)).all()


@pytest.mark.parametrize("block", [4096, 8])
def test_embedding_dedup_equals_brute_force(spark, block):
    from panelkit.llm.lattice import near_duplicates

    rng = np.random.default_rng(3)
    x, labels = [], []
    for k in range(300):
        v = rng.normal(size=64)
        v /= np.linalg.norm(v)
        x.append(v)
        for _ in range(k % 4):
            r = rng.normal(size=64)
            r -= (r @ v) * v
            c = rng.choice([0.925, 0.935, 0.95, 0.99])
            x.append(c * v + np.sqrt(1 - c * c) * r / np.linalg.norm(r))
        labels += [k % 3] * (len(x) - len(labels))
    x += [x[0], x[0], 2 * x[1]] + [x[5] + 1e-3 * rng.normal(size=64) for _ in range(40)]
    labels += [labels[0], labels[0], labels[1]] + [labels[5]] * 40
    rows = [(k, [float(np.float32(a)) for a in v], l) for k, (v, l) in enumerate(zip(x, labels))]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 64, 1), (n + 2, [float("nan")] * 64, 1), (n + 3, rows[0][1], None), (n + 4, [1.0, None], 1), (n + 5, [], 1), (n + 6, [1.0, 2.0], 0)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, label int, id int")
    out = {r.vec_id: r for r in near_duplicates(df, block=block).collect()}
    m = np.array([r[1] for r in rows[:n]])
    m /= np.linalg.norm(m, axis=1)[:, None]
    lab = np.array(labels)
    link = (m @ m.T >= 0.93) & (lab[:, None] == lab) & ~np.eye(n, dtype=bool)
    got, want = sum(out[k].n_links for k in range(n)), int(link.sum())
    assert all(out[k].n_links <= link[k].sum() for k in range(n)) and got >= 0.99 * want
    assert all(out[k].n_links == 0 and out[k].component_id == k and out[k].kept for k in range(n, n + 7))
    assert all(out[k].kept == (k == out[k].component_id) for k in range(n))
    assert near_duplicates(df.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    from panelkit.llm.components import components

    links = [(k, k + 1) for k in range(100, 130)] + [(1, k) for k in range(200, 240)] + [(240, 200), (5, 5), (None, 3), (7, 6), (6, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 131)} | {k: 1 for k in [1, *range(200, 241)]} | {6: 6, 7: 6}


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    sf, rnd = "/root/testdata/sf0.001", random.Random(1)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    base = docs.select("text", "lang", "source", "n_chars").first()
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    vocab = sorted({w for r in docs.where("lang = 'en'").select("text").limit(40).collect() for w in r.text.split() if w.isalpha()})
    clean = lambda n: " ".join(rnd.choices(vocab, k=n))
    passage = clean(80)
    extra = [(10_000, base.text), (10_001, "1234 !!"), (10_002, None), (10_003, f"{clean(60)} {item} {clean(40)}"), (10_004, f"{clean(70)} {passage}"), (10_005, f"{clean(70)} {passage} {clean(20)}"), (10_006, clean(90))]
    more = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in extra], docs.schema)
    rows = docs.unionByName(more).withColumn("score", docs.doc_id * 2)
    ids = lambda d: {r.doc_id for r in d.select("doc_id").collect()}
    known = dict(p.STAGES)
    one = known["language_id"](spark, rows, sf)
    assert one.columns == rows.columns and set(range(10_000, 10_007)) - ids(one) == {10_001, 10_002}
    two = known["near_duplicates"](spark, rows, sf)
    assert 10_000 not in ids(two) and 10_006 in ids(two) and two.columns == rows.columns
    three = known["substring_dedup"](spark, two, sf)
    text = {r.doc_id: r.text for r in three.collect()}
    assert passage in text[10_004] and passage not in text[10_005] and len(text[10_005].split()) == 90 and three.columns == rows.columns
    four = known["decontamination"](spark, rows, sf)
    assert 10_003 not in ids(four) and 10_006 in ids(four) and four.columns == rows.columns
    five = known["encoding"](spark, four, sf)
    assert five.where("not round_trip").count() == 0 and five.count() == four.count()
    assert p.run(spark, sf).count() > 0


def test_near_duplicates_keeps_one_row_of_each_group(spark):
    import corpus_pipeline as p

    rnd = random.Random(4)
    text = lambda: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(60))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, c, "x"), (3, c, "x"), (3, c, "other source"), (None, d, "x"), (None, d, "x"), (None, a, "x"), (5, d, "x"),
            (None, e, "x"), (7, None, "x"), (8, "", "x"), (9, " ", "x"), (4, a.upper(), "x")]
    # (names that clash with those the stage uses; the rows' count is that of components, not of ids)
    docs = spark.createDataFrame([(i, t, "en", s, 1, 2, 3) for i, t, s in rows], "doc_id long, text string, lang string, source string, n long, row int, component_id int")
    out = p.near_duplicates(spark, docs, "")
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert out.columns == docs.columns and got == sorted([(1, a), (2, b), (3, c), (5, d), (None, e), (7, None)], key=str)


def test_stages_of_an_empty_table_and_clashing_names(spark):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = ("fp", "row", "n_words", "kept", "matches", "score", "entropy")
    wide = docs.limit(40).select("*", *[(docs.doc_id + k).alias(n) for k, n in enumerate(names)])
    for name, stage in p.STAGES:
        few = wide.where("lang = 'none'") if name != "language_id" else docs.where("false")
        assert stage(spark, few, sf).count() == 0
        out = stage(spark, wide, sf)
        assert out.columns[:len(wide.columns)] == wide.columns and out.where("row <> doc_id + 1").count() == 0


def test_registry():
    import __spark_entry__ as e

    names = [q for q in e.queries() if q.startswith("op")]
    assert sorted({int(q[2:].split("_")[0]) for q in names}) == list(range(1, 14)) and "pipeline" in e.queries()
