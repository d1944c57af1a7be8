"""What the wrappers decide: slots by place, template texts inside articles, edited copies. Against a plain search over all pages."""

from __future__ import annotations

import random

import pytest

from sensorstream.llm import wrappers


def texts(spark, pages):
    rows = [(i, url, html) for i, (url, html) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return [r.text for r in sorted(wrappers.main_text(df).collect(), key=lambda r: r.page_id)]


def on(host, bodies):
    return [(f"http://{host}/{i}", body) for i, body in enumerate(bodies)]


@pytest.mark.parametrize("places", [1, 3])
def test_a_fixed_line_in_an_article_goes_without_a_telling_class(spark, places):
    body = "<article><h1>Title {0}</h1>" + "<p>Sentences of story {0}</p>" * places + "<p>Read more in our paper</p></article>"
    wanted = ["Title {0}" + " Sentences of story {0}" * places] * 9
    assert texts(spark, on("a.example", [body.format(i) for i in range(9)])) == [w.format(i) for i, w in enumerate(wanted)]


def test_a_fixed_block_of_some_pages_has_a_slot_of_its_own(spark):
    plain = "<article><h1>Title {0}</h1><p>Sentences of story {0}</p></article>"
    with_block = "<article><h1>Title {0}</h1><p>Sentences of story {0}</p><div>Printed last week</div></article>"
    bodies = [(with_block if i % 3 == 0 else plain).format(i) for i in range(30)]
    assert texts(spark, on("b.example", bodies)) == [f"Title {i} Sentences of story {i}" for i in range(30)]
    # the same words as a paragraph among others are text: there most pages have something else
    inner = "<article><h1>Title {0}</h1><p>Sentences of story {0}</p><p>Printed last week</p></article>"
    bodies = [(inner if i % 3 == 0 else plain).format(i) for i in range(30)]
    assert texts(spark, on("b.example", bodies))[0] == "Title 0 Sentences of story 0 Printed last week"


def test_edited_copies_of_an_article_keep_their_text(spark):
    body = "<article><h1>One title</h1><p>A short line</p><p>The longest paragraph of all is the same</p><p>edit {}</p></article>"
    wanted = "One title A short line The longest paragraph of all is the same edit {}"
    assert texts(spark, on("c.example", [body.format(i) for i in range(40)])) == [wanted.format(i) for i in range(40)]


def test_few_pages_are_no_evidence_and_hosts_do_not_mix(spark):
    body = "<article><h1>Title {0}</h1><p>Sentences of story {0}</p><p>Same</p></article>"
    pages = [(f"http://h{i % 5}.example/{i}", body.format(i)) for i in range(35)]
    assert texts(spark, pages) == [f"Title {i} Sentences of story {i} Same" for i in range(35)]


def test_an_article_of_template_only_keeps_it(spark):
    body = "<article><p>{}</p><p>Same line</p></article>"
    bodies = [body.format(f"a longer story {i}") for i in range(12)] + ["<article><p>Same line</p></article>"]
    assert texts(spark, on("d.example", bodies)) == [f"a longer story {i}" for i in range(12)] + ["Same line"]


def searched(pages):
    """The same by one loop over all pages of a host at a time, with dictionaries."""
    out = [""] * len(pages)
    for host in {url.split("/")[2] for url, _ in pages}:
        mine = [(i, wrappers.outline(html)) for i, (url, html) in enumerate(pages) if url.split("/")[2] == host]
        merged = {}
        for path in {e.path for _, (_, elements) in mine for e in elements}:
            same = [e.children for _, (_, elements) in mine for e in elements if e.path == path]
            first, *others = [wrappers.read(text) for text in sorted({wrappers.write(wrappers.fold(c)) for c in same})]
            for other in others:
                first = wrappers.align(first, other)
            merged[path] = first
        holding, filling = {}, {}
        for i, (found, elements) in mine:
            def place(number, child):
                items = wrappers.fold(elements[number].children)
                seen = []
                for k, (group, repeated, _) in enumerate(items):
                    seen += [k] * len(group)
                    while repeated and tuple(elements[number].children[len(seen) :][: len(group)]) == group:
                        seen += [k] * len(group)
                return wrappers.positions(items, merged[elements[number].path])[seen[child]]

            inner = [t for n, _, t in found if "*" in elements[n].path and "!" not in elements[n].path]
            whole = tuple((elements[n].path, t) for n, _, t in found)
            for n, child, text in found:
                e = elements[n]
                slot = (e.path, place(e.parent, e.place) if e.parent >= 0 else None, place(n, child))
                story = max((t for t in inner if t != text), key=lambda t: (len(t), t), default="") if "*" in e.path else whole
                filling.setdefault(slot, set()).add(whole)
                holding.setdefault((slot, text), set()).add(story)
        fixed = {(slot[0], text) for (slot, text), own in holding.items() if len(own) >= wrappers.TEMPLATE_PAGES and 2 * len(own) > len(filling[slot])}
        for i, (found, elements) in mine:
            clean = [(elements[n].path, t) for n, _, t in found if "!" not in elements[n].path]
            ranks = [[x for x in clean if (x in fixed) == skip and ("*" in x[0]) == inside] for skip in (False, True) for inside in (True, False)]
            out[i] = " ".join(t for _, t in next((r for r in ranks if r), []))
    return out


def test_random_hosts_against_a_plain_search(spark):
    rnd = random.Random(5)
    pages = []
    for n in range(160):
        lines = [f"some line {rnd.randrange(400)} of a story" if rnd.random() < 0.7 else rnd.choice(["Fixed one", "Fixed two"]) for _ in range(rnd.randint(0, 6))]
        blocks = [f"<{tag}>{line}</{tag}>" for line, tag in zip(lines, rnd.choices(["p", "p", "p", "h2", "div"], k=len(lines)), strict=True)]
        head = rnd.choice(["<p>Welcome</p>", "<div>Welcome</div>", ""])
        end = "<div><p>Closing words</p></div>" if rnd.random() < 0.6 else ""
        story = "".join(blocks) + end
        body = f"<article>{story}</article>" if rnd.random() < 0.6 else f"<section>{story}</section>"
        pages.append((f"http://{rnd.choice(['hot.example', 'hot.example', 'x.example'])}/{n}", f"<body>{head}<nav>Menu</nav>{body}</body>"))
    pages += pages[:20]
    found = texts(spark, pages)
    assert found == searched(pages)
    assert not any("Closing words" in t and "line" in t for t in found)


def test_each_child_of_a_sequence_has_an_item_and_each_item_a_place():
    rnd = random.Random(6)
    for _ in range(500):
        lists = [[rnd.choice("abc#") for _ in range(rnd.randint(0, 10))] for _ in range(3)]
        merged = wrappers.fold(lists[0])
        for other in lists[1:]:
            merged = wrappers.align(merged, wrappers.fold(other))
        for children in lists:
            items = wrappers.fold(children)
            own = wrappers.places(items, children)
            assert len(own) == len(children) and own == sorted(own) and set(own) == set(range(len(items)))
            assert all(child in items[k][0] for child, k in zip(children, own, strict=True))
            to = [m for m in wrappers.positions(items, merged) if m >= 0]
            assert to == sorted(set(to)) and len(wrappers.positions(items, merged)) == len(items)
