"""Main text of web pages by union-free wrapper inference (operator 3).

A page is read as a stream of block elements and of the strings between them. The streams of a host's pages of one
template are aligned one after the other: a string that all of them have is a constant of the template, any other
string is a text slot; a run of alike elements (or of alike pairs or triples of elements) becomes a repeated group,
and what only some pages have becomes optional. The result is a regular expression without unions, the wrapper.

The slots decide: the article is the element that holds most of the running text in slots, and a page's text is what
its strings match of that element's slots. Strings that match constants go. Semantic tags (nav, aside, form ...) are
never article; class names that consist of telling words alone (``cookie-notice``, but not ``notice-period``) settle
what the slots leave open: an element so named goes unless it holds nine tenths of the running text.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small_batches

#: Pages of a host's template from which its wrapper is inferred, a bounded sample: by hash, unlike pages first.
SAMPLE = 8
#: Pages that must share a string before it counts as the template's.
STEADY_PAGES = 3
#: Wrappers and the sample's hashes are broadcast up to these sizes (counted before), and joined by a shuffle beyond.
BROADCAST_BYTES, BROADCAST_ROWS, SALTS = 8 << 20, 500_000, 16
#: A template repeats a string within a page at most so often.
REPEATED = 4
#: A string of so many characters that is the longest of every page marks copies of one article, not a template.
COPIED = 200
#: The article's element holds at least this share of the text in slots; an element with a telling name, the other.
MOST, NEARLY_ALL = 0.6, 0.9

#: The least share of the text that an article beside records has; elements of titles.
SOME, TITLES = 0.03, frozenset({"h1", "h2"})

_NAME_END = re.compile(r"[\s/>]")
_ATTRS = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript iframe template svg object title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul br".split()
)
#: A tag of the first kind ends an open one of the second.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NEVER = frozenset("head script style noscript template iframe svg object title nav aside form button select textarea input footer dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: A name is telling if it has a word of the first list and none that is in neither.
HINTS = frozenset(
    "ad ads adv advert advertisement advertising adsense adbox sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice popup modal overlay newsletter subscribe share sharing "
    "social comment comments commentlist disqus respond related recommended login signup search pager pagination toolbar".split()
)
FILLERS = frozenset("site page top bottom left right main primary secondary global box bar list area section wrap wrapper container block widget inner outer row col item items button buttons link links icon icons form posts header text content reader readers user users visitor visitors thread".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
REGIONS = ("article", "main")
#: Elements that hold one paragraph's text or a list: an article is not narrowed down to one of them.
PARAGRAPHS = frozenset("p pre blockquote ul ol dl li table h1 h2 h3 h4 h5 h6 dd dt td tr br".split())


@dataclass(slots=True)
class Node:
    tag: str
    name: str = ""  # class or id, without digits: with the tag, what an alignment goes by
    never: bool = False
    hint: bool = False
    block: bool = False  # it is or holds a block element
    kids: list = field(default_factory=list)  # Node or str


def telling(label: str) -> bool:
    """Whether a class or id consists of words that only menus, adverts and the like are named by."""
    for name in label.split():
        words = {x.lower() for x in _WORD.findall(name)}
        if words & HINTS and words <= HINTS | FILLERS:
            return True
    return False


def parse(html: str) -> Node:
    """A lenient tree of a page: unclosed and misplaced tags are mended, comments dropped. Linear in the page: an
    unclosed tag or quote is looked for once."""
    root = Node("")
    made, stack, inner, opened, at, n, quotes = [root], [root], [0], Counter(), 0, len(html), True

    def text(s: str) -> None:
        if s:
            stack[-1].kids.append(unescape(s))

    def leave(depth: int) -> None:
        for x in stack[depth:]:
            opened[x.tag] -= 1
        del stack[depth:], inner[depth:]

    while at < n:
        start = html.find("<", at)
        if start < 0:
            text(html[at:])
            break
        mark = html[start + 1 : start + 2]
        end = mark == "/"
        first = html[start + 2 : start + 3] if end else mark
        if not (first.isascii() and first.isalpha()) and mark not in ("!", "?"):
            text(html[at : start + 1])
            at = start + 1
            continue
        text(html[at:start])
        if mark in ("!", "?"):
            close, skip = ("-->", 3) if html.startswith("<!--", start) else ("]]>", 3) if html.startswith("<![CDATA[", start) else (">", 1)
            stop = html.find(close, start + 4 if skip == 3 else start)
            if skip == 3 and close == "]]>":
                stack[-1].kids.append(html[start + 9 : stop if stop >= 0 else n])
            at = n if stop < 0 else stop + skip
            continue
        begin = start + (2 if end else 1)
        name_end = _NAME_END.search(html, begin)
        if name_end is None:
            break
        tag, here = html[begin : name_end.start()].lower(), name_end.start()
        found = _ATTRS.match(html, here) if quotes else None
        if found is None:
            quotes = False  # a quote or tag that never ends: from here on tags end at the next ">"
            stop = html.find(">", here)
            if stop < 0:
                break
            at = stop + 1
        else:
            at = found.end()
        attrs_text = html[here : at - 1]
        if end:
            if opened[tag]:
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                leave(depth)
            elif tag in ("p", "br"):
                made.append(Node(tag))
                stack[-1].kids.append(made[-1])
            continue
        closes = CLOSES.get(tag) or ({"p"} if tag in BLOCK and tag != "br" else None)
        if closes:
            d = inner[-1]
            while d > 0:  # from block element to block element
                if stack[d].tag in closes:
                    leave(d)
                    if tag != "tr":
                        break
                elif not (tag == "tr" and stack[d].tag in ("td", "th")):
                    break
                d = inner[d - 1]
        attrs = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs_text)} if attrs_text.strip(" \t\r\n/") else {}
        label = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        hint = tag not in ("html", "body", *REGIONS) and label != " " and telling(label)
        hint = hint or tag == "header" and not any(opened[x] for x in REGIONS)
        node = Node(tag, re.sub(r"\d+", "", label).strip().lower(), tag in NEVER or attrs.get("role", "").lower() in ROLES, hint, tag in BLOCK)
        stack[-1].kids.append(node)
        made.append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = close.end() if close else n
        elif tag not in VOID and not attrs_text.endswith("/"):
            stack.append(node)
            inner.append(len(stack) - 1 if node.block else inner[-1])
            opened[tag] += 1
    for node in reversed(made):  # the inner ones first
        node.block = node.block or any(not isinstance(k, str) and k.block for k in node.kids)
    return root


# -- a page as block elements and strings


@dataclass(slots=True)
class Text:
    """The text between two borders of blocks, with its white space made even."""

    text: str
    linked: int  # characters of it in links


@dataclass(slots=True)
class Block:
    tag: str
    name: str = ""
    hint: bool = False
    kids: list = field(default_factory=list)  # Block or Text
    chars: int = 0  # running text in it, without links and without elements with a telling name
    linked: int = 0


def outline(root: Node) -> Block:
    """The block elements of a page and the strings between them; semantic junk is left out."""
    top = Block("")
    opened, made, buffer = [top], [top], []
    linked = depth = 0

    def flush() -> None:
        nonlocal linked
        s = " ".join("".join(buffer).split())
        if s:
            opened[-1].kids.append(Text(s, min(linked, len(s))))
        buffer.clear()
        linked = 0

    todo: list = root.kids[::-1]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            buffer.append(x)
            if depth:
                linked += len(x)
        elif isinstance(x, tuple):  # the end of an element
            if x[0].block:
                flush()
                opened.pop()
            depth -= x[0].tag == "a"
        else:
            if x.block:
                flush()
            if x.never or x.hint and not x.block:
                continue
            if x.block:
                made.append(Block(x.tag, x.name, x.hint))
                opened[-1].kids.append(made[-1])
                opened.append(made[-1])
            depth += x.tag == "a"
            todo.append((x,))
            todo.extend(reversed(x.kids))
    flush()
    for b in reversed(made):
        for k in b.kids:
            if isinstance(k, Text):
                b.chars, b.linked = b.chars + len(k.text) - k.linked, b.linked + k.linked
            elif not k.hint:
                b.chars, b.linked = b.chars + k.chars, b.linked + k.linked
    return top


def strings(top: Block) -> list[str]:
    """All strings of a page in order, without those of elements with a telling name."""
    out, todo = [], [top]
    while todo:
        x = todo.pop()
        if isinstance(x, Text):
            out.append(x.text)
        elif not x.hint or x is top:
            todo.extend(reversed(x.kids))
    return out


# -- wrappers


def _run(call: Generator):
    """What a generator returns that yields the calls it waits for. Pages nest deeper than Python's own stack."""
    stack, value = [call], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as end:
            stack.pop()
            value = end.value
    return value


@dataclass(slots=True)
class Item:
    """A term of a wrapper: a string (tag "#"; constant or, with None, a slot), an element, or a group (tag "")."""

    tag: str
    name: str = ""
    shape: str = ""
    constant: str | None = None
    often: bool = False
    optional: bool = False
    hint: bool = False
    chars: int = 0  # running text in its slots, over the pages seen
    kids: list = field(default_factory=list)

    @property
    def key(self):
        return (self.tag, self.name, self.shape, self.constant) if self.tag else ("", *(k.key for k in self.kids))

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
                continue
            mark = "*" if x.often and x.optional else "+" if x.often else "?" if x.optional else ""
            open_, close = (f"<{x.tag}>", f"</{x.tag}>") if x.tag not in ("", "#") else ("", "")
            if x.tag == "#":
                open_ = "#" if x.constant is None else x.constant
            todo += [close + (")" + mark if mark else ""), *reversed(x.kids), ("(" if mark else "") + open_]
        return "".join(out)


def shape(block: Block, steady) -> tuple[str, str | None]:
    """What a block is matched by besides its tag and name: whether all its strings are constants ("F", with the
    string if it is only one), whether most of its text is in links ("L"), or neither."""
    if len(block.kids) == 1 and isinstance(block.kids[0], Text) and block.kids[0].text in steady:
        return "F", block.kids[0].text
    return ("L" if block.linked > block.chars else ""), None


def _repeats(items: list[Item]) -> Generator:
    """Runs of alike terms, or of alike pairs or triples, as repeated groups. Constants are terms of their own."""

    def alike(a: list[Item], b: list[Item]) -> bool:
        for x, y in zip(a, b, strict=True):
            if x.key != y.key or x.constant is not None:
                return False
            few, many = sorted((x.chars, y.chars))
            deep = any(k.tag != "#" for k in (*x.kids, *y.kids))
            if deep and x.tag not in PARAGRAPHS and many > 200 and few * 8 < many:
                return False  # containers of very different size have different parts to play
        return True

    for period in (1, 2, 3):
        out: list[Item] = []
        at = 0
        while at < len(items):
            first = items[at : at + period]
            end = at + period
            while len(first) == period and any(x.tag != "#" for x in first) and end + period <= len(items) and alike(first, items[end : end + period]):
                both, first = list(zip(first, items[end : end + period])), []
                for a, b in both:
                    first.append((yield _unify(a, b)))
                end += period
            if end == at + period or len(first) < period:
                out.append(items[at])
                at += 1
                continue
            group = first[0] if period == 1 else Item("", kids=first, chars=sum(x.chars for x in first))
            group.often = True
            out.append(group)
            at = end
        items = out
    return items


def _unify(a: Item, b: Item) -> Generator:
    """The least general term that covers both."""
    out = Item(a.tag, a.name, a.shape, a.constant, a.often or b.often, a.optional or b.optional, a.hint, a.chars + b.chars)
    if a.tag == "#":
        return out
    for op, a0, a1, b0, b1 in SequenceMatcher(None, [x.key for x in a.kids], [x.key for x in b.kids], autojunk=False).get_opcodes():
        if op == "equal":
            for x, y in zip(a.kids[a0:a1], b.kids[b0:b1]):
                out.kids.append((yield _unify(x, y)))
            continue
        for x in (*a.kids[a0:a1], *b.kids[b0:b1]):
            x.optional = True
            out.kids.append(x)
    if len(out.kids) > 1:
        out.kids = yield _repeats(out.kids)
    return out


def to_wrapper(block: Block, steady) -> Generator:
    """The wrapper of a single page, given the template's constant strings."""
    kids = []
    for k in block.kids:
        if isinstance(k, Text):
            constant = k.text if k.text in steady else None
            kids.append(Item("#", constant=constant, chars=0 if constant is not None else len(k.text) - k.linked))
        else:
            kids.append((yield to_wrapper(k, steady)))
    form, constant = shape(block, steady)
    item = Item(block.tag, block.name, form, constant, hint=block.hint, kids=(yield _repeats(kids)))
    item.chars = sum(k.chars for k in item.kids if not k.hint)
    return item


def _elements(item: Item) -> Iterator[tuple[Item, bool]]:
    """The elements directly below an item, and whether they are of a repeated group."""
    for k in item.kids:
        if k.tag == "":
            for x in k.kids:
                if x.tag != "#":
                    yield x, True
        elif k.tag != "#":
            yield k, k.often


def _marks(top: Item) -> dict[int, tuple[bool, bool]]:
    """Whether there is a title, and a title or paragraph, in each item or below it; one pass, of any depth."""
    order, todo = [], [top]
    while todo:
        order.append(todo.pop())
        todo += order[-1].kids
    found: dict[int, tuple[bool, bool]] = {}
    for k in reversed(order):
        below = [found[id(x)] for x in k.kids]
        title = k.tag in TITLES or any(t for t, _ in below)
        found[id(k)] = title, title or k.tag == "p" or any(p for _, p in below)
    return found


def _listed(item: Item, marks: dict) -> bool:
    """Whether most of an item's text is in repeated records without a title, such as comments and teasers; repeated
    paragraphs and lists are no records."""
    records = sum(k.chars for k, often in _elements(item) if often and k.tag not in PARAGRAPHS)
    return records > 0 and 2 * records >= item.chars and not marks[id(item)][0]


def region(top: Item) -> tuple[list, Item]:
    """The way to the element that holds most of the running text in slots, and that element. Records do not count,
    however many they are, where an element beside them has paragraphs of its own (and ``SOME`` of the text); a telling
    name is overruled only by text that is no list of records."""
    path, here, marks = [], top, _marks(top)
    while True:
        inner = list(_elements(here))
        listed = [k for k, often in inner if not often and k.tag not in REGIONS and _listed(k, marks)]
        records = {id(k) for k in listed}
        other = any(not k.hint and id(k) not in records and k.chars >= SOME * here.chars and marks[id(k)][1] for k, _ in inner)
        lists = {id(k) for k in listed if k.hint or other}
        own = here.chars - sum(k.chars for k, _ in inner if not k.hint and id(k) in lists)
        everything = own + sum(k.chars for k, _ in inner if k.hint and id(k) not in lists)
        wanted = [(k, often) for k, often in inner if id(k) not in lists and k.chars >= (NEARLY_ALL * everything if k.hint else MOST * own)]
        best, often = max(wanted, key=lambda k: k[0].chars, default=(None, False))
        if best is None or not best.chars or often or best.tag in PARAGRAPHS:
            return path, here
        path.append([best.tag, best.name, best.shape])
        here = best
        if best.tag in REGIONS and not any(k.tag in REGIONS and k.chars >= MOST * here.chars for k, _ in _elements(here)):
            return path, here


@dataclass
class Wrapper:
    """What reading a page needs of its template's expression: the way to the article's element, and that element's
    terms, [key, often, terms] each, without the terms below those that hold no constant."""

    path: list | None = None
    terms: list = field(default_factory=list)
    expression: str = ""


def _terms(item: Item) -> Generator:
    out = []
    for k in item.kids:
        if k.tag == "":
            group = []
            for x in k.kids:
                group.append([list(x.key), True, (yield _terms(x))])
            out.append(["", True, group])
        elif k.tag == "#":
            if k.constant is not None:
                out.append([list(k.key), k.often, []])
        else:
            out.append([list(k.key), k.often, (yield _terms(k))])
    # Without a constant below, nothing has to be matched here.
    return out if any(t[0] == "" and any(g[2] or g[0][3] is not None for g in t[2]) or t[0] != "" and (t[2] or t[0][3] is not None) for t in out) else []


def steady_strings(trees: list[Block]) -> set[str]:
    """Strings that all the pages have, each equally often and a few times at most. Pages that share their longest string too are copies of one article: of
    these, and of too few pages, none is known to be the template's."""
    if len(trees) < STEADY_PAGES:
        return set()
    lists = [strings(t) for t in trees]
    longest = {max(x, key=len, default="") for x in lists}
    if len(longest) == 1 and len(next(iter(longest))) >= COPIED:
        return set()
    counts = [Counter(x) for x in lists]
    steady = {x for x, n in counts[0].items() if n <= REPEATED and all(c[x] == n for c in counts[1:])}
    return steady if any(set(x) - steady for x in lists) else set()


def infer(pages: list[str]) -> Wrapper:
    """Align the pages one by one and find the article's place. Copies of a page count once."""
    trees = [outline(parse(html)) for html in dict.fromkeys(pages)]
    if not trees:
        return Wrapper()
    steady = steady_strings(trees)
    joint = _run(to_wrapper(trees[0], steady))
    for tree in trees[1:]:
        joint = _run(_unify(joint, _run(to_wrapper(tree, steady))))
    path, here = region(joint)
    return Wrapper(path, _run(_terms(here)), str(joint))


def _constants(terms: list) -> set[str]:
    found, todo = set(), list(terms)
    while todo:
        key, _, inner = todo.pop()
        if key and key[3] is not None:
            found.add(key[3])
        todo += inner
    return found


def _find(top: Block, path: list, steady) -> Block | None:
    """The path's element; among siblings alike, the one with the most text."""
    node = top
    for tag, name, form in path:
        alike = [k for k in node.kids if isinstance(k, Block) and k.tag == tag and k.name == name and shape(k, steady)[0] == form]
        if not alike:
            return None
        node = max(alike, key=lambda k: k.chars) if len(alike) > 1 else alike[0]
    return node


def _read(node: Block, terms: list, steady, whole_page: bool) -> list[str]:
    """The strings of an element that match no constant of the wrapper's terms, in page order."""
    out: list[str] = []
    todo: list = [(node, terms)]
    while todo:
        x, terms = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        flat = [(g, i, often) for i, (key, often, inner) in enumerate(terms) for g in (inner if key == "" else [[key, often, inner]])]
        at, kept = 0, []
        for k in x.kids:
            if isinstance(k, Text):
                key = ["#", "", "", k.text if k.text in steady else None]
            else:
                if k.hint or whole_page and x is node and k.linked > k.chars and k.tag not in PARAGRAPHS - {"ul", "ol"}:
                    continue
                key = [k.tag, k.name, *shape(k, steady)]
            match = next((t for t in flat if t[1] >= at and t[0][0] == key), None) if flat else None
            if match:
                at = match[1] if match[2] else match[1] + 1
                if key[3] is not None:
                    continue  # a constant in its place
            kept.append(k.text if isinstance(k, Text) else (k, match[0][2] if match else []))
        todo.extend(y if isinstance(y, tuple) else (y, None) for y in reversed(kept))
    return out


def main_text(html: str, wrapper: Wrapper) -> str:
    """The page's article: read through the wrapper, or, where the page has no such place, through its own."""
    top = outline(parse(html))
    steady = _constants(wrapper.terms)
    node = _find(top, wrapper.path, steady) if wrapper.path is not None else None
    terms, path = wrapper.terms, wrapper.path
    if node is None or not node.chars and not node.linked:
        path, _ = region(_run(to_wrapper(top, ())))
        node, terms, steady = _find(top, path, ()) or top, [], set()
    whole = not path or path[-1][0] in ("html", "body")
    found = _read(node, terms, steady, whole) or _read(node, [], set(), whole)
    return "\n".join(found)


# -- Spark


def _hosts(pages: DataFrame, url_col: str):
    """Lower-case host of the url; the empty string for none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _template(html):
    """A number for the page's frame: its first container tags with their class names, without digits."""
    found = F.regexp_extract_all(html, F.lit(r"(?i)<(?:body|main|article|section|div|header|nav|table)(?:\s+class=[\x22\x27][^\x22\x27<>]*)?"), F.lit(0))
    return F.xxhash64(F.regexp_replace(F.lower(F.array_join(F.slice(found, 1, 6), " ")), r"\d", ""))


def _longest(html):
    """A number for the longest string between tags, outside scripts and styles."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1", "<")
    return F.xxhash64(F.array_max(F.transform(F.split(bare, "<[^>]*>?"), lambda x: F.struct(F.length(x).alias("n"), x.alias("x")))))


def wrappers(pages: DataFrame, sample: int = SAMPLE, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, template, wrapper (JSON), expression: one row for each template of each host, from at most ``sample`` of
    its pages. Every page takes part in the choice: of each template first pages whose longest strings differ."""
    html = F.col("html")
    keyed = pages.select(_hosts(pages, url_col).alias("host"), F.col(html_col).alias("html")).where("html is not null").withColumn("template", _template(html)).withColumn("h", F.xxhash64("html"))
    # A bounded number of candidates for each template, by partial aggregation: a hot host costs no more than others.
    groups = ["host", "template", F.pmod(_longest(html), F.lit(64)).alias("like"), F.pmod("h", F.lit(4)).alias("part")]
    few = keyed.groupBy(*groups).agg(F.min("h").alias("h"))
    few = few.withColumn("again", F.row_number().over(Window.partitionBy("host", "template", "like").orderBy("h")))
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("host", "template").orderBy("again", "h"))).where(F.col("r") <= sample)
    few = cut(few.select("host", "template", "h"))
    chosen = keyed.join(F.broadcast(few) if few.count() <= BROADCAST_ROWS else few, ["host", "template", "h"], "left_semi").dropDuplicates(["host", "template", "h"])

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        w = infer(pdf.sort_values("h").html.to_list())
        return pd.DataFrame({"host": [pdf.host.iloc[0]], "template": [pdf.template.iloc[0]], "wrapper": [json.dumps([w.path, w.terms])], "expression": [w.expression]})

    return chosen.groupBy("host", "template").applyInPandas(learn, "host string, template long, wrapper string, expression string")


def extract(pages: DataFrame, sample: int = SAMPLE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page, from the whole html: id, url, text, n_chars.

    Null html counts as empty and gives an empty text, as does a page without an article. A null url, or one
    without a host, belongs to the host "". Repeated rows give repeated results; an empty table gives an empty
    table; other columns are not read. A line break element ends a block. Very long and very deep pages are read
    whole, in time proportional to their size.
    """
    spark = pages.sparkSession
    small_batches(spark)
    kind = pages.schema[id_col].dataType.simpleString()
    known = cut(wrappers(pages, sample, url_col, html_col).select("host", "template", "wrapper"))
    size = known.agg(F.sum(F.length("wrapper") + F.length("host") + 8)).first()[0] or 0
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), _hosts(pages, url_col).alias("host"))
    rows = rows.withColumn("template", _template(F.col("html")))
    keys = ["host", "template"]
    if size <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(known), keys, "left")
    else:  # a hot host's pages go to several tasks
        salts = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int")).join(salts, [*keys, "salt"], "left")
    joined = joined.select("id", "url", "html", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, Wrapper] = {}
        for batch in batches:
            texts = []
            for html, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if w not in cache:
                    if len(cache) > 10_000:
                        cache.clear()
                    cache[w] = Wrapper(*json.loads(w)) if w else Wrapper()
                texts.append(main_text(html or "", cache[w]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[id_col, "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"{id_col} {kind}, url string, text string, n_chars long")
