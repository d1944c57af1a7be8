from __future__ import annotations

import random
import time

import pytest

from sensorstream.llm import queries, wrappers

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header>Site</header><nav><ul><li>Menu<li>Two</ul></nav><div id="cookie-notice">We use cookies</div>
<article class="post"><header><h1>Head &amp; line</h1></header><p>First <b>bo</b>ld &lt;tag&gt; &amp;amp;<br>line<p>Second
<div class="ad-slot">Buy</div><ul><li>one<li>two</ul><form>Name <input></form><section id="comments"><p>Nice!</p></section>
<footer>By me</footer></article><aside>Side</aside><div class="sidebar">Bar</div><footer>&copy; us</footer>"""
TEXT = "Head & line First bold <tag> &amp; line Second one two"


def texts(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    return {r.page_id: r.text for r in wrappers.main_text(df).collect()}


def test_only_the_article_stays(spark):
    assert texts(spark, [(1, "http://a.example/x", PAGE, "old")]) == {1: TEXT}


def test_template_texts_go_where_there_is_no_article(spark):
    page = "<body><div>Welcome to our site</div><div><p>{}</p></div><p>All rights stay here</p></body>"
    pages = [(i, f"http://b.example/{i}", page.format(f"story {i} told"), None) for i in range(12)]
    found = texts(spark, pages)
    assert found == {i: f"Welcome to our site story {i} told All rights stay here" for i in range(0)} | {i: f"story {i} told" for i in range(12)}


def test_copies_of_a_page_keep_their_text(spark):
    page = "<body><div>Welcome to our site</div><p>{}</p></body>"
    copies = [(i, f"http://c.example/{i}", page.format("one story"), None) for i in range(20)]
    assert texts(spark, copies) == {i: "Welcome to our site one story" for i in range(20)}
    few = [*copies, *((i, f"http://c.example/{i}", page.format(f"story {i}"), None) for i in range(20, 24))]
    assert texts(spark, few)[0] == "Welcome to our site one story"
    many = [*copies, *((i, f"http://c.example/{i}", page.format(f"story {i}"), None) for i in range(20, 30)), (30, "http://c.example/30", page.format(""), None)]
    found = texts(spark, many)
    assert (found[0], found[20], found[30]) == ("one story", "story 20", "Welcome to our site")


def test_alignment_accepts_all_it_was_made_from():
    rnd = random.Random(1)
    for _ in range(300):
        lists = [[rnd.choice("abcd#") for _ in range(rnd.randint(0, 9))] for _ in range(4)]
        items = wrappers.fold(lists[0])
        for other in lists[1:]:
            items = wrappers.align(items, wrappers.fold(other))
        assert wrappers.read(wrappers.write(items)) == items


def test_expressions():
    made = wrappers.align(wrappers.fold(["h1", "p", "p", "p", "ul"]), wrappers.fold(["h1", "#", "p"]))
    assert wrappers.write(made) == "(h1)(#)?(p)+(ul)?"
    assert wrappers.accepts(wrappers.write(made), ["h1", "#", "p", "p"])
    assert not wrappers.accepts(wrappers.write(made), ["p", "h1"])
    assert wrappers.write(wrappers.fold(list("abababc"))) == "(a b)+(c)"


def test_wrappers_of_a_host(spark):
    pages = spark.createDataFrame([(1, "http://a.example/1", "<body><h1>x</h1><p>a<p>b</body>"), (2, "http://A.example/2", "<body><h1>y</h1><p>c<div>d</div></body>")], "page_id long, url string, html string")
    models, slots = wrappers.infer(pages)
    assert {r.path: r.expression for r in models.collect()}["/body"] == "(h1)(p)+(div)?"
    assert {r.path: r.literal is None for r in slots.collect()} == {"/body/h1": True, "/body/p": True, "/body/div": False}


def test_edges(spark):
    long = "<article>" + "<div>" * 3000 + "word " * 100_000
    rows = [(1, None, None, None), (2, "", "", "x"), (3, "no url", "plain words", "x"), (4, "http://h/1", long, None), (4, "http://h/1", long, None), (None, "http://h/2", "<p>a < b & c<p", None),
            (6, "http://h/3", '<a title="open>x</a><p>still here', None), (7, "http://h/4", "<!-- never closed <p>x", None), (8, "http://h/5", "<script>never closed", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = wrappers.main_text(df).collect()
    assert len(found) == len(rows)
    by = {r.page_id: r.text for r in found}
    assert (by[1], by[2], by[3], by[7], by[8]) == ("", "", "plain words", "", "")
    assert by[4] == ("word " * 100_000).strip()
    assert by[None].startswith("a < b & c")
    assert wrappers.main_text(df.limit(0)).count() == 0


def test_optional_head_and_body():
    for start in ("<head><title>T</title><body>", "<html><head><meta charset=u><body class=x>", "<head><title>T</title>", "<title>T</title>", "<head></head>"):
        found, _ = wrappers.parse(start + "<article><p>Story</p></article>")
        assert [(p.endswith("/article*/p") and "!" not in p, t) for p, t in found] == [(True, "Story")]
    assert wrappers.parse("<head> <title>T</title> words <p>more")[0] == [("", "words"), ("/p", "more")]


def test_a_form_around_the_page_is_a_container(spark):
    page = "<body><form action=x><nav>Menu</nav><article><p>Story</p><form>Name <input></form><p>end</p></article></form></body>"
    around = "<body><form><div><h1>Title</h1><p>Words</p></div><input></form></body>"
    assert texts(spark, [(1, "http://f.example/1", page, None), (2, "http://g.example/1", around, None)]) == {1: "Story end", 2: "Title Words"}
    assert wrappers.page_forms("<form><label>a</label><p><input></p></form><h1>x</h1>") == set()


@pytest.mark.parametrize("unit", ['<a "', "<!", "<a", '<p "\'>', "<p '\">", "</script", "<script>x</script", "<![CDATA[", "<div class='", "<p class=\"a\" '>x", "<", "&", "<b \"'>\"<i '\">"])
@pytest.mark.parametrize("tail", ["", ">", '"', "'>"])
def test_hostile_pages_take_time_by_their_length(unit, tail):
    started = time.process_time()
    wrappers.parse(unit * (600_000 // len(unit)) + tail)
    assert time.process_time() - started < 8


def test_tag_ends_from_the_table_are_those_of_the_scan():
    rnd = random.Random(3)
    for _ in range(3000):
        page = "".join(rnd.choice("<p>\"' a/=") for _ in range(rnd.randint(0, 40)))
        where, ends = wrappers._tag_ends(page)
        for at in range(len(page) + 1):
            rest = wrappers._REST.match(page, at)
            k = next((k for k, w in enumerate(where) if w >= at), None)
            assert (rest.end() if rest else -1) == (-1 if k is None else ends[k]), (page, at)


def test_long_sequences_are_aligned_without_a_square():
    rnd = random.Random(4)
    a = [((rnd.choice("abcdefgh") + str(rnd.randrange(50)),), False, False) for _ in range(20_000)]
    b = [x for x in a if rnd.random() > 0.1] + a[:100]
    started = time.process_time()
    found = wrappers.align(a, b)
    assert time.process_time() - started < 20
    # each of the two is what is left of the expression without some optional groups
    for items in (a, b):
        rest = iter(found)
        kept = sum(any(x[0] == group for x in rest) for group, _, _ in wrappers.tidy(items))
        assert kept == len(wrappers.tidy(items))


def test_deep_pages_have_short_paths():
    page = "<article>" + "<div><section>" * 3000 + "deep" + "</section></div>" * 3000 + "</article>"
    found, models = wrappers.parse(page)
    assert [t for _, t in found] == ["deep"] and "*" in found[0][0] and "!" not in found[0][0]
    assert sum(map(len, models)) < 4_000_000 and len(models) == 6002


def test_query(spark):
    found = queries.QUERIES["op2_wrappers"](spark, "/root/testdata/sf0.001").collect()
    assert len(found) == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert all(r.n_chars == len(r.text) for r in found)
