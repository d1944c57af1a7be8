"""Main text of web pages by wrappers inferred per host.

A page becomes a stream of block elements and texts. Over all pages of a host, the child sequences met
under one element path are aligned one after the other into a union-free regular expression:
runs that repeat become iterated groups, and what one sequence lacks becomes an optional group. The
expressions of a host's paths are its wrapper. Each sequence is then matched with its path's expression, which
gives every text a slot: its path, the place of its element among the parent's children and its own
place in the element, as items of the two expressions. Within a slot texts that differ between pages are content; a
text that most of the different pages filling the slot have there is a part of the template, inside articles
too. Slots below menus, page headers, footers, sidebars, notices, adverts, forms and reader comments never carry
content; if a page fills slots inside an article these are its text, otherwise the others. A page that has
nothing but template text keeps it.

Pages are different by all their texts. Inside articles those that hold a text count as different only by the longest other
text there, so that neither copies nor edited copies of one article make a template of it.

Sequences, places and hashes of texts are gathered where the pages lie; only different sequences of a path travel, and
they are merged in two levels, so a host with a third of all pages costs no more than another.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from heapq import nlargest
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorstream.llm.common import pieces, table

#: A text may be template from so many different pages on, fewer are no evidence; branches of the merge tree; longest repeated group.
TEMPLATE_PAGES, BRANCHES, GROUP = 8, 64, 4
#: Sequences are aligned by a full table up to so many cells, longer ones from anchors; paths are written out up to so many characters.
TABLE_CELLS, LONG_PATH = 250_000, 400

# Names of elements and words of class, id and role attributes, by what they mean here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = set("script style noscript template iframe textarea title".split())
DROPPED = set("head svg math object nav footer aside form menu dialog button select fieldset audio video canvas".split()) | RAW
OPTIONAL_END = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
PARAGRAPH_END = set("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SCOPE = set("html body article section main div aside nav table ul ol dl td th li footer header form blockquote".split())
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertising advertorial adsense sponsor sponsored promo promotion promoted banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar sidebar sidebars sidenav aside rail footer foot colophon masthead topbar "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall newsletter subscribe subscription signup login "
    "search share sharing social comment comments commentlist disqus discussion respond replies reply feedback related recommended recommendations widget widgets copyright disclaimer skip "
    "complementary contentinfo".split()
)
# Elements that make a form a part of the page's frame.
STRUCTURE = set("article main nav header footer aside h1 h2".split())
HEAD_WORDS = {"header", "head"}
CONTENT_WORDS = {("article", "body"), ("article", "content"), ("post", "content"), ("post", "body"), ("entry", "content"), ("main", "content"), ("story", "body"), ("page", "content")}

# Where a tag, comment or declaration may begin, the rest of a tag with its quoted values, and the ends of raw elements.
_OPENING = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|[!?])")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_SPECIAL = re.compile(r"""[>"']""")
_RAW_END = {name: re.compile(rf"</{name}(?![a-zA-Z0-9])[^>]*(?:>|\Z)", re.I) for name in RAW}
_HINT = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def _words(attributes: str) -> list[tuple[str, ...]]:
    out = []
    for m in _HINT.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            parts = tuple(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower().replace("-", " ").replace("_", " ").split())
            if parts and parts[0] not in ("no", "has", "with", "is", "js", "without"):
                out.append(parts)
    return out


def _label(name: str, attributes: str, inside: bool) -> str:
    """The element's name, with `!` if nothing below it is content and `*` if it is an article."""
    if name in DROPPED:
        return name + "!"
    words = _words(attributes) if attributes.strip() else []
    if name in ("html", "body"):
        return name
    if name in ("article", "main") or ("main",) in words or any(w[:2] in CONTENT_WORDS or (len(w) == 1 and w[0] in ("article", "maincontent")) for w in words):
        return name + "*"
    if any(part in NOISE_WORDS for w in words for part in w):
        return name + "!"
    if not inside and (name == "header" or any(part in HEAD_WORDS for w in words for part in w)):
        return name + "!"
    return name


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """All of `>`, `"` and `'` in the page, and for each the end of a tag that goes on there outside of quotes, or -1."""
    marks = [(m.start(), m[0]) for m in _SPECIAL.finditer(page)]
    ends = [-1] * len(marks)
    later = {'"': -1, "'": -1}
    for k in range(len(marks) - 1, -1, -1):
        where, mark = marks[k]
        if mark == ">":
            ends[k] = where + 1
        else:
            shut, later[mark] = later[mark], k
            if 0 <= shut < len(marks) - 1:
                ends[k] = ends[shut + 1]
    return [where for where, _ in marks], ends


def tokens(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, closing, name, attributes) of tags, and of comments and declarations without a name; a CDATA section has its text as
    attributes. Raw elements come whole, with their content. A quoted value may hold `>`; where quotes do not match up, the tag ends
    at the next `>`. What never ends is text, but for comments, CDATA and raw elements, which end with the page.

    Scans that came to nothing are counted; when they add up to more than the page, the ends of all tags are looked up
    in a table made once, from the back, so that the whole stays linear."""
    last = page.rfind(">")
    table_: tuple[list[int], list[int]] | None = None
    wasted = at = 0
    while m := _OPENING.search(page, at):
        start, head = m.start(), m.end()
        if not m[2]:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                yield start, len(page) if end < 0 else end + 3, False, "", ""
                at = len(page) if end < 0 else end + 3
            elif page[start : start + 9].upper() == "<![CDATA[":
                end = page.find("]]>", start + 9)
                yield start, len(page) if end < 0 else end + 3, False, "", page[start + 9 : len(page) if end < 0 else end]
                at = len(page) if end < 0 else end + 3
            elif head <= last:
                at = page.find(">", head) + 1
                yield start, at, False, "", ""
            else:
                at = head
            continue
        name = m[2].lower()
        if head > last:
            # nothing ends any more, but a comment or CDATA section may still begin
            at = head
            continue
        if name in RAW and not m[1]:
            at = page.find(">", head) + 1
            shut = _RAW_END[name].search(page, at)
            at = shut.end() if shut else len(page)
            yield start, at, False, name, ""
            continue
        if table_ is None and wasted > len(page):
            table_ = _tag_ends(page)
        if table_ is None:
            rest = _REST.match(page, head)
            end = rest.end() if rest else -1
            wasted += 0 if rest else len(page) - head
        else:
            k = bisect_left(table_[0], head)
            end = table_[1][k] if k < len(table_[0]) else -1
        if end < 0:
            end = page.find(">", head) + 1
        yield start, end, bool(m[1]), name, page[head : end - 1]
        at = end


def page_forms(page: str) -> set[int]:
    """Where forms begin that are laid around (part of) a page: they hold structure, not just controls and their labels."""
    found: set[int] = set()
    open_: list[int] = []
    if "<form" not in page and "<FORM" not in page and "<Form" not in page:
        return found
    for start, _, closing, name, _ in tokens(page):
        if name == "form":
            if not closing:
                open_.append(start)
            elif open_:
                open_.pop()
        elif open_ and not closing and name in STRUCTURE:
            found.update(open_)
            open_.clear()
    return found


def _below(path: str, label: str) -> str:
    """The path one element down. A long one goes on from a digest, which keeps both marks, so deep pages stay linear."""
    if len(path) > LONG_PATH:
        path = "/" + "".join(mark for mark in "!*" if mark in path) + format(_hash(path) + 2**63, "016x")
    return f"{path}/{label}"


class Element(NamedTuple):
    """A block element: its path, its parent and its place there (numbers in lists), its children's labels."""

    name: str
    label: str
    path: str
    children: list[str]
    number: int
    parent: int
    place: int


def outline(page: str) -> tuple[list[tuple[int, int, str]], list[Element]]:
    """The page's texts in order, as (number of the element, place among its children, text), and its elements. Paths name
    the open block elements; an element within one of its own label shares its path. A text runs on through inline elements; line
    breaks count as white space. Elements left open end with their parents or the page; a head also ends at the first text or element
    that cannot be in it. The work grows with the page's length, whatever the markup."""
    texts: list[tuple[int, int, str]] = []
    elements = [Element("", "", "", [], 0, -1, 0)]
    stack = elements[:]
    run: list[str] = []

    def flush() -> None:
        if run:
            value = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if value:
                texts.append((stack[-1].number, len(stack[-1].children), value))
                stack[-1].children.append("#")

    def leave_head() -> None:
        while stack[-1].name == "head":
            stack.pop()

    forms = page_forms(page)
    at = 0
    for start, end, closing, name, attributes in tokens(page):
        between = page[at:start]
        if between:
            if stack[-1].name == "head" and not between.isspace():
                leave_head()
            run.append(between)
        at = end
        if name in RAW:
            flush()
            stack[-1].children.append(name + "!")
            continue
        if not name:
            if attributes:
                run.append(html.escape(attributes))
            continue
        if name in INLINE:
            continue
        if name == "br" or name in VOID:
            run.append(" ")
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    while len(stack) > k:
                        stack.pop()
                    break
                if name in OPTIONAL_END and stack[k].name in SCOPE and stack[k].name != name:
                    break
            continue
        leave_head()
        ends = OPTIONAL_END.get(name, set()) | ({"p"} if name in PARAGRAPH_END else set())
        while len(stack) > 1 and stack[-1].name in ends:
            stack.pop()
        parent = stack[-1]
        label = name if start in forms else _label(name, attributes, "*" in parent.path)
        path = parent.path if parent.label == label else _below(parent.path, label)
        stack.append(Element(name, label, path, [], len(elements), parent.number, len(parent.children)))
        elements.append(stack[-1])
        parent.children.append(label)
    if at < len(page):
        if not page[at:].isspace():
            leave_head()
        run.append(page[at:])
    flush()
    return texts, elements


def parse(page: str) -> tuple[list[tuple[str, str]], dict[str, list[list[str]]]]:
    """The page's texts in order, as (path, text), and the child sequences of its elements by path."""
    texts, elements = outline(page)
    models: dict[str, list[list[str]]] = {}
    for element in elements:
        models.setdefault(element.path, []).append(element.children)
    return [(elements[number].path, text) for number, _, text in texts], models


# ---- union-free expressions: lists of (group of labels, repeated, optional) -----------------------

Item = tuple[tuple[str, ...], bool, bool]


def fold(children: list[str]) -> list[Item]:
    """A sequence with its immediate repetitions folded into iterated groups, longest stretch first at each place."""
    out: list[Item] = []
    k = 0
    while k < len(children):
        best, width = 0, 1
        for w in range(1, GROUP + 1):
            n = 1
            while children[k : k + w] == children[k + n * w : k + (n + 1) * w] and k + (n + 1) * w <= len(children):
                n += 1
            if n > 1 and n * w > best:
                best, width = n * w, w
        group = tuple(children[k : k + width])
        out.append((group, best > 0, False))
        k += best or 1
    return tidy(out)


def tidy(items: list[Item]) -> list[Item]:
    """Neighbours of the same group become one iterated group."""
    out: list[Item] = []
    for item in items:
        if out and out[-1][0] == item[0]:
            out[-1] = (item[0], True, out[-1][2] and item[2])
        else:
            out.append(item)
    return out


def places(items: list[Item], children: list[str]) -> list[int]:
    """For each child the number of its item in the folded sequence."""
    out: list[int] = []
    for number, (group, repeated, _) in enumerate(items):
        width = len(group)
        out += [number] * width
        while repeated and tuple(children[len(out) : len(out) + width]) == group:
            out += [number] * width
    return out


def positions(sequence: list[Item], expression: list[Item]) -> list[int]:
    """For each item of a folded sequence the item of the expression that it is aligned with, or -1."""
    out = [-1] * len(sequence)
    for k, m in _common([x[0] for x in sequence], [x[0] for x in expression]):
        out[k] = m
    return out


def _common(a: list, b: list) -> list[tuple[int, int]]:
    """Index pairs of a common subsequence of two sequences, in order: the longest one where the table
    of the parts that differ is small; else what surrounds the values that both have once, in the same order; without such
    values the next occurrence in turn. No table grows with the square of long sequences."""
    work = [(0, len(a), 0, len(b))]
    pairs: list[tuple[int, int]] = []
    while work:
        i0, i1, j0, j1 = work.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            pairs.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            pairs.append((i1, j1))
        if i0 == i1 or j0 == j1:
            continue
        if (i1 - i0) * (j1 - j0) <= TABLE_CELLS:
            best = [[0] * (j1 - j0 + 1) for _ in range(i1 - i0 + 1)]
            for i in range(i1 - 1, i0 - 1, -1):
                row, below = best[i - i0], best[i - i0 + 1]
                for j in range(j1 - 1, j0 - 1, -1):
                    row[j - j0] = below[j - j0 + 1] + 1 if a[i] == b[j] else max(below[j - j0], row[j - j0 + 1])
            i, j = i0, j0
            while i < i1 and j < j1:
                if a[i] == b[j]:
                    pairs.append((i, j))
                    i, j = i + 1, j + 1
                elif best[i - i0 + 1][j - j0] >= best[i - i0][j - j0 + 1]:
                    i += 1
                else:
                    j += 1
            continue
        counts_a, counts_b = Counter(a[i0:i1]), Counter(b[j0:j1])
        where = {x: j for j, x in enumerate(b[j0:j1], j0) if counts_b[x] == 1 and counts_a[x] == 1}
        anchors = _rising([(i, where[a[i]]) for i in range(i0, i1) if a[i] in where])
        if anchors:
            pairs.extend(anchors)
            edges = [(i0 - 1, j0 - 1), *anchors, (i1, j1)]
            work.extend((p + 1, r, q + 1, t) for (p, q), (r, t) in zip(edges, edges[1:]))
            continue
        places: dict = {}
        for j in range(j0, j1):
            places.setdefault(b[j], []).append(j)
        j = j0
        for i in range(i0, i1):
            own = places.get(a[i], [])
            k = bisect_left(own, j)
            # not so far ahead that one odd element uses up the other sequence
            if k < len(own) and own[k] - j <= max(i1 - i0, j1 - j0) // 8:
                pairs.append((i, own[k]))
                j = own[k] + 1
    return sorted(pairs)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs whose second parts rise as the first ones do."""
    tops: list[int] = []
    ends: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        place = bisect_right(tops, j)
        back[k] = ends[place - 1] if place else -1
        tops[place : place + 1] = [j]
        ends[place : place + 1] = [k]
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[Item], b: list[Item]) -> list[Item]:
    """The union-free expression over two: groups of a common subsequence stay, what only one has is optional."""
    out: list[Item] = []
    i = j = 0
    for k, m in [*_common([x[0] for x in a], [x[0] for x in b]), (len(a), len(b))]:
        out += [(group, repeated, True) for group, repeated, _ in [*a[i:k], *b[j:m]]]
        if k < len(a):
            out.append((a[k][0], a[k][1] or b[m][1], a[k][2] or b[m][2]))
        i, j = k + 1, m + 1
    return tidy(out)


def write(items: list[Item]) -> str:
    """As text: labels in brackets, `+` for iterated, `?` for optional, `*` for both; `#` is a text."""
    return "".join(f"({' '.join(group)}){ {(0, 0): '', (1, 0): '+', (0, 1): '?', (1, 1): '*'}[bool(repeated), bool(optional)]}" for group, repeated, optional in items)


def read(text: str) -> list[Item]:
    return [(tuple(g.split(" ")), mark in ("+", "*"), mark in ("?", "*")) for g, mark in re.findall(r"\(([^()]*)\)([+?*]?)", text)]


def accepts(expression: str, children: list[str]) -> bool:
    """Whether a child sequence belongs to the expression."""
    pattern = "".join(f"(?:{''.join(re.escape(x) + ' ' for x in group)}){'*' if r and o else '+' if r else '?' if o else ''}" for group, r, o in read(expression))
    return re.fullmatch(pattern, "".join(f"{c} " for c in children)) is not None


# ---- jobs ----------------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    found: list[Item] | None = None
    for text in sorted(group["expression"]):
        found = read(text) if found is None else align(found, read(text))
    return group.iloc[:1].assign(expression=write(found or []))


def gather(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """What the wrappers need of all pages, as a table with rows of three kinds: (host, path, expression, seq), a folded child sequence;
    (host, path, key, above, above_item, seq, item), a place where texts stand, by sequences of the element and its parent; and
    (key, text, page, story), that a text stands at a place of a page, with hashes of the text, of all the page's texts, and of what tells
    stories apart: inside articles the longest other text there."""
    names = ["host", "path", "expression", "seq", "item", "above", "above_item", "key", "text", "page", "story"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    schema = "host string, path string, expression string, seq long, item int, above long, above_item int, key long, text long, page long, story long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequences: set[tuple] = set()
            stands: set[tuple] = set()
            for part in pieces(batch, "page"):
                filled: set[tuple[int, int, int, int]] = set()
                for host, value in zip(part.column("host").to_pylist(), part.column("page").to_pylist(), strict=True):
                    texts, elements = outline(value or "")
                    folded = [fold(e.children) for e in elements]
                    own = [places(items, e.children) for items, e in zip(folded, elements, strict=True)]
                    written = [write(items) for items in folded]
                    seqs = [_hash(f"{host}\n{e.path}\n{text}") for e, text in zip(elements, written, strict=True)]
                    sequences.update((host, e.path, text, seq) for e, text, seq in zip(elements, written, seqs, strict=True))
                    whole = _hash("\0".join(f"{elements[n].path}\n{text}" for n, _, text in texts))
                    inner = {t for n, _, t in texts if "*" in elements[n].path and "!" not in elements[n].path}
                    longest = [*nlargest(2, inner, key=lambda t: (len(t), t)), "", ""]
                    first, second = _hash(longest[0]), _hash(longest[1])
                    for number, place, text in texts:
                        e = elements[number]
                        if "!" in e.path:
                            continue
                        above, above_item = (seqs[e.parent], own[e.parent][e.place]) if e.parent >= 0 else (0, 0)
                        item = own[number][place]
                        key = _hash(f"{above} {above_item} {seqs[number]} {item}")
                        stands.add((host, e.path, seqs[number], item, above, above_item, key))
                        story = whole if "*" not in e.path else second if text == longest[0] else first
                        filled.add((key, mark(e.path, text), whole, story))
                yield _batch([(None,) * 7 + x for x in filled], kinds, names)
            yield _batch([(*x, *(None,) * 7) for x in sequences], kinds, names)
            yield _batch([(host, path, None, *x, None, None, None) for host, path, *x in stands], kinds, names)

    read_ = pages.select(host_of(F.col(url)).alias("host"), F.col(page).alias("page"))
    return table(read_.mapInArrow(run, schema), "wrapper-parts")


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text) - 2**63


def mark(path: str, text: str) -> int:
    """A text at a path, as a hash."""
    return _hash(f"{path}\n{text}")


def expressions(found: DataFrame) -> DataFrame:
    """(host, path, expression): all sequences of a host and path, merged."""
    parts = found.where("expression is not null").select("host", "path", "expression").distinct()
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("expression"), F.lit(BRANCHES)))
    kind = "host string, path string, expression string"
    once = salted.groupBy("host", "path", "salt").applyInPandas(_merge, kind + ", salt long")
    return once.drop("salt").groupBy("host", "path").applyInPandas(_merge, kind)


def slots_of(found: DataFrame, models: DataFrame) -> DataFrame:
    """(key, host, path, slot): the slot of every place, from the alignment of its two sequences with the wrapper."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seq, sequence, model in zip(*(batch.column(c).to_pylist() for c in ("seq", "sequence", "expression")), strict=True):
                rows = [(seq, k, m) for k, m in enumerate(positions(read(sequence), read(model)))]
                yield _batch(rows, [pa.int64(), pa.int32(), pa.int32()], ["seq", "item", "position"])

    parts = found.where("expression is not null").select("host", "path", F.col("expression").alias("sequence"), "seq").distinct()
    placed = parts.join(models, ["host", "path"]).mapInArrow(run, "seq long, item int, position int")
    stands = found.where("item is not null").select("key", "host", "path", "seq", "item", "above", "above_item").distinct()
    above = placed.select(F.col("seq").alias("above"), F.col("item").alias("above_item"), F.col("position").alias("above_position"))
    known = stands.join(placed, ["seq", "item"]).join(above, ["above", "above_item"], "left")
    return known.select("key", "host", "path", F.xxhash64("host", "path", "above_position", "position").alias("slot"))


def fillings(found: DataFrame, slots: DataFrame) -> DataFrame:
    """(slot, text, page, story), each once: which texts fill a slot on which different pages."""
    stand = found.where("text is not null").select("key", "text", "page", "story")
    return stand.join(slots.select("key", "slot"), "key").select("slot", "text", "page", "story").distinct()


def infer(pages: DataFrame, url: str = "url", page: str = "html") -> tuple[DataFrame, DataFrame]:
    """The wrappers of all hosts, from all pages: (host, path, expression), and (host, path, slot, literal, differ) with the
    hash of the text if a slot always has the same one, and on how many different pages it is filled."""
    found = gather(pages, url, page)
    models = table(expressions(found), "wrapper-models")
    slots = table(slots_of(found, models), "wrapper-slots")
    filled = fillings(found, slots)
    differ = filled.select("slot", "page").distinct().groupBy("slot").agg(F.count(F.lit(1)).alias("differ"))
    literal = filled.groupBy("slot").agg(F.when(F.min("text") == F.max("text"), F.min("text")).alias("literal"))
    return models, slots.select("host", "path", "slot").distinct().join(literal, "slot").join(differ, "slot")


def template_texts(found: DataFrame, slots: DataFrame) -> DataFrame:
    """(host, template): per host the hashes (see `mark`) of texts that more than half of the different pages filling their slot have there,
    and no fewer than `TEMPLATE_PAGES`. A host has no more of them than about two pages have texts per slot."""
    filled = table(fillings(found, slots), "wrapper-fillings")
    often = filled.select("slot", "text", "story").distinct().groupBy("slot", "text").agg(F.count(F.lit(1)).alias("holding")).where(F.col("holding") >= TEMPLATE_PAGES)
    differ = filled.select("slot", "page").distinct().groupBy("slot").agg(F.count(F.lit(1)).alias("differ"))
    fixed = often.join(differ, "slot").where(2 * F.col("holding") > F.col("differ")).select("slot", "text")
    hosts = slots.select("slot", "host").distinct()
    return fixed.join(hosts, "slot").groupBy("host").agg(F.array_sort(F.collect_set("text")).alias("template"))


def extract(pages: DataFrame, templates: DataFrame, url: str = "url", page: str = "html", text: str = "text") -> DataFrame:
    """Add `text` to every page: the texts of its content slots in page order, joined by one space. A column of that
    name is replaced; other columns pass through. A page without any has its template texts. Null or empty pages and pages without content have the
    empty text; pages without a host share one wrapper. Every page is kept, repeated ones too. Spark
    broadcasts the templates if they are small and splits hot hosts otherwise."""
    keep = [f for f in pages.schema.fields if f.name != text]
    names = [f.name for f in keep]
    schema = pages.select(*names).withColumn(text, F.lit("").cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, page):
                out = []
                for value, template in zip(part.column(page).to_pylist(), part.column("_template").to_pylist(), strict=True):
                    fixed = set(template or ())
                    clean = [(p, t, bool(fixed) and mark(p, t) in fixed) for p, t in parse(value or "")[0] if "!" not in p]
                    chosen: list[str] = []
                    for skip in (False, True):
                        for inside in (True, False):
                            chosen = chosen or [t for p, t, known in clean if known == skip and ("*" in p) == inside]
                    out.append(" ".join(chosen))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(out, pa.string())], names=[*names, text])

    named = templates.select(F.col("host").alias("_host"), F.col("template").alias("_template"))
    joined = pages.select(*names, host_of(F.col(url)).alias("_own")).join(named, F.col("_own") == F.col("_host"), "left").drop("_own", "_host")
    return joined.mapInArrow(run, schema)


def main_text(pages: DataFrame, url: str = "url", page: str = "html", text: str = "text") -> DataFrame:
    """Wrappers of all hosts from all pages, then the main text of every page."""
    found = gather(pages, url, page)
    models = table(expressions(found), "wrapper-models")
    slots = table(slots_of(found, models), "wrapper-slots")
    return extract(pages, table(template_texts(found, slots), "wrappers"), url, page, text)
