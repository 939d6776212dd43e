"""HTML extraction, decontamination and the pipeline."""

import itertools
import random
import re
import time
from html import unescape

import pytest

import corpus_pipeline
from folio.llm import decontaminate, html_mincut, queries
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_minimum_cut_is_minimal():
    r = random.Random(2)
    for _ in range(200):
        n = r.randint(1, 8)
        price = [r.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, r.uniform(0, 1.5)) for a in range(n) for b in range(a + 1, n) if r.random() < 0.5]

        def cost(side):
            return sum(abs(p) for p, s in zip(price, side, strict=True) if (p > 0) != s) + sum(w for a, b, w in edges if side[a] != side[b])

        assert cost(html_mincut.minimum_cut(price, edges)) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))


def test_minimum_cut_of_long_pages():
    """Undecided blocks in the thousands, their siblings nested or crossing, take linear time;
    the result is that of the flow alone."""
    def page(n, r, nested=0.8):
        found, open_ = [], [0]
        for i in range(n):
            if r.random() < 0.3:
                open_.append(i + 1)
            elif len(open_) > 1 and r.random() < 0.4:
                open_.pop()
            parent = open_[-1] if r.random() < nested or len(open_) < 2 else open_[-2]
            found.append(html_mincut.Block("x", None, 0.0, None, parent))
        return [r.uniform(-0.6, 0.6) for _ in range(n)], html_mincut.ties(found)

    r = random.Random(4)
    for _ in range(50):
        price, edges = page(60, r)
        near = [{} for _ in price]
        for a, b, w in edges:
            near[a][b] = near[b][a] = near[a].get(b, 0.0) + w
        assert html_mincut.minimum_cut(price, edges) == html_mincut._augment(price, near, list(range(len(price))))
    for nested in (0.5, 0.8, 1.0):
        price, edges = page(60_000, r, nested)
        began = time.process_time()
        assert len(set(html_mincut.minimum_cut(price, edges))) == 2
        assert time.process_time() - began < 5


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site-header"><h1>Site</h1><a href=/>Home</a></header>
<div id=cookie-banner><p>We use cookies to improve your experience on this site. Please accept them all now.</p></div>
<div class="left"><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div class="middle"><h2>A title &amp; more</h2>
<p>First long paragraph of the   text that says a lot of things, and goes on for more than a hundred characters to be sure.<p>Short one.
<p>Another long paragraph of the text that says a lot of things &lt; goes on for more than a hundred characters to be sure.<br>New line.</div>
<aside><p>Buy now our great product, which is a long sentence that goes on and on and on for a while.</p></aside><!-- <p>no</p> -->
<section id="comments"><article class="comment"><p>Great post! I really enjoyed reading all of this and want to say so at length, more than anyone asked.</p></article></section>
<form><p>Subscribe to the newsletter for more long sentences that go on and on.</p><input></form><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert html_mincut.main_text(PAGE) == "\n\n".join([
        "A title & more", "First long paragraph of the text that says a lot of things, and goes on for more than a hundred characters to be sure.", "Short one.",
        "Another long paragraph of the text that says a lot of things < goes on for more than a hundred characters to be sure. New line."])
    for odd in (None, "", "<", "<p", "<!-- never closed", "<script>never closed", "<a href='never closed", "</p></div>"):
        assert html_mincut.main_text(odd) in ("", "<")
    deep = "<div>" * 30_000 + "word " * 100 + "</div>" * 30_000
    assert html_mincut.main_text("<article>" + deep) == ("word " * 100).strip()


def test_main_text_in_layout_wrappers():
    para = "A long paragraph of the text that says a lot of things, and goes on for more than a hundred characters to be sure of that."
    article = f"<article><h1>Title</h1><p>{para}</p></article>"
    aside = "<div class='sidebar'><p>Buy now our great product, which is a long sentence that goes on and on and on for a while.</p></div>"
    for before in ("<body style='overflow:hidden'>", "<body class='overflow-hidden'>", "<div class=\"overflow-hidden\">", "<body class='has-sidebar single'>", "<html class=no-sidebar>", "<div class='content-sidebar-wrap'>",
                   "<div class='sidebar-layout'>", "<div class='page-with-sidebar'>", "<div style='overflow-x: hidden; display: block'>", "<div data-state='hidden'>", "<body class='right-sidebar'>"):
        assert html_mincut.main_text(before + article + aside) == f"Title\n\n{para}", before
    assert html_mincut.main_text(article.replace("<article>", "<article class='overflow-hidden no-sidebar'>")) == f"Title\n\n{para}"
    assert html_mincut.main_text(f"<div class='right-sidebar'><main><p>{para}</p></main></div>") == para
    for hidden in ("<div hidden>", "<div hidden=''>", "<div class=x aria-hidden='true'>", "<div style='color:red; display : none'>", "<div class='sidebar'>", "<div class='comments'>", "<div class='sidebar-wrapper'>"):
        assert html_mincut.main_text(f"{article}{hidden}<p>{para} Not this.</p></div>") == f"Title\n\n{para}", hidden
    items = ["First linked item", "Second item is here", "A third"]
    links = "<ul>" + "".join(f"<li><a href=x>{x}</a></li>" for x in items) + "</ul>"
    assert html_mincut.main_text(f"<article><p>{para}</p>{links}<p>{para}</p></article>") == "\n\n".join([para, *items, para])
    assert html_mincut.main_text(f"<div><ul><li><a href=x>Home</a></li></ul></div><article><p>{para}</p><nav>{links}</nav></article>{links}") == para


def test_main_text_under_names_of_its_subject():
    """Categories, tags, states and anchors in names are no votes against a text."""
    para = "A long paragraph of the text that says a lot of things, and goes on for more than a hundred characters to be sure of that."
    side = "<div class='sidebar-left'><p>Buy now our great product, which is a long sentence that goes on and on and on.</p></div>"
    for start, end in (("<article class='post type-post category-reviews tag-search'>", "</article>"), ("<article class='post comments-open'>", "</article>"),
                       ("<article id='follow-the-money'>", "</article>"), ("<article><div class='post-content ad-free'>", "</div></article>"),
                       ("<article><div class='entry-content social-share-enabled'>", "</div></article>"), ("<main class='site-main legal-article'>", "</main>"),
                       ("<article><section id='related-work'>", "</section></article>"), ("<article><section id='discussion'>", "</section></article>"),
                       ("<div class='post-content ad-free'>", "</div>"), ("<div class='entry-content social-share-enabled'>", "</div>"), ("<div class='legal-article'>", "</div>")):
        assert html_mincut.main_text(f"<body>{start}<h2 id='search'>Title of it</h2><p>{para}</p><p>{para}</p>{end}{side}</body>") == f"Title of it\n\n{para}\n\n{para}", start
    linked = "<article><p><a href=x>A paragraph that is a link</a></p><p><a href=y>And another one</a></p></article>"
    assert html_mincut.main_text(linked) == "A paragraph that is a link\n\nAnd another one"
    assert html_mincut.main_text("<article><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>E=m</annotation></math> here.</p></article>") == "Energy is E=m here."
    for name in ("related-posts", "post-comments", "share-buttons", "cookie-banner", "newsletter-signup", "comment-content", "right-sidebar", "widget-area", "ad-slot-1", "adBanner"):
        assert html_mincut.main_text(f"<article><p>{para}</p><p>{para}</p><div class='{name}'><p>{para} Not this.</p></div></article>") == f"{para}\n\n{para}", name


def test_classifier_fits_what_tags_tell(spark):
    """Blocks under article and nav tell the rest: of pages without such tags, long sentences
    are kept and rows of links are not; without examples the prior stands."""
    para = "A long paragraph of the text that says a lot of things, and goes on for more than a hundred characters to be sure of that."
    links = "".join(f"<div><a href={i}>Link {i} to a page</a></div>" for i in range(5))
    page = f"<nav>{links}</nav><article><h1>Title</h1><p>{para}</p><p>Short one.</p></article><footer><p>By us</p></footer>"
    plain = f"<div>{links}</div><div><p>{para}</p><p>Short one.</p><p>{para}</p></div><div>{links}</div>"
    pages = spark.createDataFrame([(i, f"u{i}", page) for i in range(40)] + [(99, None, plain), (None, None, None)], "page_id long, url string, html string")
    weights = html_mincut.fit(pages)
    assert weights != html_mincut.PRIOR and weights[1] > 0 > weights[2]
    got = {r.page_id: r.text for r in html_mincut.extract(pages).collect()}
    assert got[99] == f"{para}\n\nShort one.\n\n{para}" and got[0] == f"Title\n\n{para}\n\nShort one."
    assert html_mincut.fit(pages.filter("page_id = 99")) == html_mincut.PRIOR == html_mincut.fit(pages.limit(0))


def test_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r.page_id: r for r in queries.op9_minimum_cut_html(spark, SF_SMALL).collect()}
    for p in pages.collect():
        inner = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", p.html, re.S)[1].replace("<br>", " "))
        blocks = [" ".join(unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[p.page_id].text == "\n\n".join(b for b in blocks if b)
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url
    odd = spark.createDataFrame([(None, None, None, "x"), (1, "u", "", "x"), (1, "u", "", "x")], "page_id long, url string, html string, text string")
    assert [r.text for r in html_mincut.extract(odd).collect()] == ["", "", ""] and html_mincut.extract(odd.limit(0)).count() == 0


ITEMS = [(0, "If Alice buys 12 apples at 3 dollars and Bob buys 12 pears, how much did Alice spend in total today?"), (1, "too short"), (2, None), (3, ""),
         (4, "seven plain words without any slot here"), (5, "the long road winds slowly over hills and rivers until at last it meets the grey old town"), (5, "the long road winds slowly over hills and rivers until at last it meets the grey old town"),
         (6, "él vivió años en la montaña, allí más allá del río ñandú; después volvió a pié.")]


def test_decontamination(spark):
    bench = spark.createDataFrame([(*x, "y") for x in ITEMS], "item_id long, text string, doc_id string")
    filler = " ".join(brute.vocabulary(3, 60))
    leaked = {1: filler + " " + ITEMS[0][1], 2: "So if Carol buys 45 apples at 9 euros and Dave buys 45 pears, how much did Carol spend in total today? " + filler,
              3: ITEMS[4][1].upper() + "!!", 5: "LA VIDA!! " + ITEMS[-1][1].upper().replace(" ", "!! ", 3), 4: filler + "\n" + ITEMS[5][1] + ".\n" + filler}
    clean = {10: filler, 11: None, 12: "", 13: "too short", 14: "12 apples at 3 dollars " * 30,
             15: "If Carol buys 45 apples at 9 euros and Dave buys 46 pears, how much did Erin spend in total today?"}
    rows = [(d, t, None, None) for d, t in (leaked | clean).items()] + [(4, leaked[4], None, None), (None, leaked[1], None, None)]
    docs = brute.frame(spark, rows)
    got = decontaminate.leaks(docs, bench).collect()
    assert {r.doc_id for r in got} == {*leaked, None}
    changed = next(r for r in got if r.doc_id == 2)
    assert changed.item_id == 0 and changed.n_changed == changed.n_slots > 0
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(clean)
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0 and decontaminate.leaks(docs.limit(0), bench).count() == 0


def test_decontamination_judges_every_occurrence(spark):
    bench = spark.createDataFrame([ITEMS[0]], "item_id long, text string")
    piece, filler = "If Carol buys 45 apples at 9 euros then leave.", " ".join(brute.vocabulary(3, 60))
    other = "If Carol buys 45 apples at 9 euros and Dave buys 45 pears, how much did Erin spend in total today?"
    rows = [(1, f"{piece} {ITEMS[0][1]}", None, None), (2, f"{piece} {filler} {piece} {ITEMS[0][1]} {piece}", None, None), (3, f"{other} {ITEMS[0][1]}", None, None), (4, f"{piece} {filler}", None, None)]
    got = {r.doc_id: r for r in decontaminate.leaks(brute.frame(spark, rows), bench).collect()}
    assert set(got) == {1, 2, 3}
    assert all(r.matched == r.total and r.n_changed == 0 for r in got.values())


def test_decontamination_finds_short_and_unspaced_items(spark):
    items = ["Solve 3x + 5 y = 20", "Who wrote Hamlet?", "小明有五个苹果,又买了三个,现在一共有几个?", "りんごはいくつありますか。", "เขามีแอปเปิ้ลห้าลูก", "7 11 13 17 19 23 29 31 37 41"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    filler = " ".join(brute.vocabulary(3, 60))
    around = ["{} " + filler, filler + " «{}» " + filler, "他说。{}这是一个问题。", "問題:{}答えなさい。", "คำถาม{}คำตอบ", filler + "\n{}\n"]
    rows = [(i, a.format(x), None, None) for i, (a, x) in enumerate(zip(around, items, strict=True))]
    rows += [(10, "Solve 3x + 6 y = 20", None, None), (11, "Who wrote it? Hamlet", None, None), (12, "小明有五个苹果", None, None), (13, "苹果小明", None, None), (14, "11 7 13 19 17", None, None)]
    got = [tuple(r)[:2] for r in decontaminate.leaks(brute.frame(spark, rows), bench).collect()]
    assert sorted(got) == [(i, i) for i in range(len(items))]


def test_decontamination_of_repetitive_texts(monkeypatch):
    """A text and an item that repeat: found, the same in runs of any size, in linear time."""
    item, text = "tick 5 tock 7 and " * 60, "tick 5 tock 8 and " * 3000
    block = decontaminate.block_of([1], [item])
    found = decontaminate.matches(decontaminate._texts([text.encode(), b"tick tock"]), block)
    assert [(d, i, m == n) for d, i, m, n, *_ in found] == [(0, 0, True)]
    filler = " ".join(brute.vocabulary(3, 60))
    mixed = f"{filler} tick 5 tock 7 {item[:200]} {filler} {item} {filler}".encode()
    whole = decontaminate.matches(decontaminate._texts([mixed]), block)
    monkeypatch.setattr(decontaminate, "HITS", 1)
    assert decontaminate.matches(decontaminate._texts([mixed]), block) == whole and whole


def test_decontamination_takes_names_at_any_place(spark):
    tom = "Tom has 5 apples. Tom buys 3 more. Tom eats 2 of his apples. Tom gives 1 away. How many are left?"
    alice = "In town Alice and Bob met Carol, then Alice told Bob that Carol and Alice like Bob."
    bench = spark.createDataFrame([(0, tom), (1, alice), (2, "What is the longest river of Africa?")], "item_id long, text string")
    filler = " ".join(brute.vocabulary(3, 60))
    rows = [(1, f"{filler}. {tom.replace('Tom', 'Anna').replace('5', '7')} {filler}", 0, None), (2, alice.lower(), 1, None),
            (3, alice.replace(" Alice", "\nAlice").replace(" Bob", "\nBob").replace(" Carol", "\nCarol"), 1, None),
            (10, "Where is the longest river of Europe?", None, None), (11, filler, None, None)]
    got = {r.doc_id: r for r in decontaminate.leaks(brute.frame(spark, [(d, t, None, None) for d, t, *_ in rows]), bench).collect()}
    assert {d: r.item_id for d, r in got.items()} == {1: 0, 2: 1, 3: 1}
    assert (got[1].n_changed, got[2].n_changed, got[3].n_changed) == (5, 0, 0)


def test_decontamination_in_blocks(spark, monkeypatch):
    bench, docs = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("benchmark", "documents"))
    whole = {tuple(r) for r in decontaminate.leaks(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    assert {tuple(r) for r in decontaminate.leaks(docs, bench).collect()} == whole
    items = {b.item_id: brute.words_of(b.text) for b in bench.collect()}
    want = {(d.doc_id, i) for d in docs.collect() for i, w in items.items() if " ".join(w) in " ".join(brute.words_of(d.text))}
    assert want <= {x[:2] for x in whole}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, before, SF_SMALL)
        if name != "tokens":
            assert docs.columns == before.columns
        docs = docs.cache()
        seen.append(docs.count())
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "near_dedup":
            want = brute.near_components([(r.doc_id, r.text) for r in before.collect()], 5)
            assert ids == {d for d, x in want.items() if x[2]}
    assert seen[0] > seen[1] > seen[2] >= seen[3] and seen[4] == seen[5] > 0
    none = brute.frame(spark, [(1, "x", "en", "s")]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF_SMALL)
        assert none.count() == 0


def test_every_operator_has_its_query():
    names = [n for n in queries.QUERIES if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and "pipeline" in queries.QUERIES


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    from tools.compare import digest, duck
    got = queries.QUERIES[name](spark, SF_SMALL)
    want = duck(SF_SMALL).sql(queries.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert digest(got.columns, [tuple(r) for r in got.collect()])[0] == digest(list(want.columns), want.fetchall())[0]
