"""HTML extraction by tree scoring.

A page becomes a tree. Paragraphs pass points for their length and commas to their ancestors, less at each level; a container's
points are discounted by the share of its text that is links. Where the page marks the article that holds the best container, the
whole of that article is kept. Elsewhere the best container is kept with what stands beside it, up to the enclosing main or likely
container, or the page, but for parts that are mostly links. Menus, headers, footers, sidebars, notices, adverts, forms and reader
comments go before the scoring and whatever holds them; a word in a class that marks such a part does not count where the part holds
much of the page's text, and a word that may as well name a subject counts only where the part's structure agrees. A run of parts of one
make, each signed with an author or a date, that follows the text is taken for reader comments, whatever its name.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, tidy

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
DROPPED = frozenset(
    "head script style title noscript template nav aside iframe object embed applet canvas svg audio video select button input textarea dialog menu search noframes xmp annotation annotation-xml".split()
)
# Words in a class, id or role that mark what is not the article.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe subscription signup login paywall sidebar sidenav aside complementary menu menubar nav navbar navigation breadcrumb breadcrumbs pager pagination toc "
    "header masthead topbar footer contentinfo copyright share sharing social related recommended recommendations comment comments commentlist disqus respond reply replies discussion discussions widget skip alert search".split()
)
# The same for what is likely the article.
ARTICLE = frozenset("article articlebody body content entry hentry main post story text".split())
# Words that may stand beside a boilerplate word in a name and say nothing themselves.
NEUTRAL = frozenset(
    "area article articles bar block body bottom box button buttons col column container content danger desktop fixed form global group here holder home icon icons image info inner item items label law "
    "left link links list main media message middle mobile network networks news next now outer page pages panel policy post posts previous primary right row secondary section site slot small sticky "
    "stories story success text this title toggle top topics trail unit us warning wrap wrapper".split()
)

# Of the boilerplate words those that hold whatever the length of the text.
FIRM = frozenset("comment comments commentlist disqus respond reply replies discussion discussions cookie cookies consent gdpr".split())
# Of the boilerplate words those that also name a subject or a picture.
AMBIGUOUS = frozenset("search banner alert skip widget overlay toc".split())
# Words of a class that sign a contribution with its author or its date.
SIGNS = frozenset("author byline user username avatar date datetime time timestamp posted poster nickname".split())
#: Text before a run of signed parts from which it is one of comments.
BEFORE_COMMENTS = 200
# First words of a name that says what a part has, or what it is about.
QUALIFIERS = frozenset("no not has with without category tag topic type format".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose id is a place to link to, and whose name has to say in full that they are not the article.
TEXTUAL = HEADINGS | frozenset("p blockquote pre li dt dd td th tr figcaption caption".split())
#: Parts beside the best container are kept below this share of text in links.
MOST_LINKS = 0.33
#: Share of the page's text from which a boilerplate word no longer counts, without and with a word for the article; and a form or
#: header around everything on a page that marks no article.
OVERRULED, OVERRULED_LIKELY, OVERRULED_WHOLE = 0.5, 0.2, 0.9

_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=(?:\s*+\"[^\"]*\"|\s*+'[^']*')?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[^\s]+")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: An element that one of these opens, when the same parent's one is open, ends that one first.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th")}
_SCOPE = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",), "tbody": ("table",)}


class Node:
    __slots__ = ("tag", "parent", "children", "unlikely", "likely", "unsure", "signed", "name", "points", "chars", "links")

    def __init__(self, tag: str, parent: Node | None, unlikely: int = 0, likely: bool = False, unsure: bool = False, signed: bool = False, name: str = ""):
        self.tag, self.parent, self.unlikely, self.likely = tag, parent, unlikely, likely
        self.unsure, self.signed, self.name = unsure, signed or tag == "time", name
        self.children: list[Node | str] = []
        self.points = 0.0
        self.chars = self.links = 0


def _says(name: str, tag: str, within: bool) -> tuple[int, bool]:
    """(not the article, likely the article) of one class, id or role. A name of several words speaks against the article only where
    its last word does, or where a boilerplate word has nothing but neutral ones beside it; "no-sidebar" is no sidebar, and a header
    within the article is the article's."""
    words = _WORD.findall(_CAMEL.sub("-", name).lower())
    likely = any(w in ARTICLE for w in words)
    found = [w for w in words if w in BOILERPLATE]
    if not found or words[0] in QUALIFIERS:
        return 0, likely
    if words[-1] not in BOILERPLATE and any(w not in BOILERPLATE and w not in NEUTRAL for w in words):
        return 0, likely
    if found == ["header"] and (within or tag not in BLOCK or tag in TEXTUAL or len(words) > 1 and (likely or "section" in words)):
        return 0, likely
    return 2 if any(w in FIRM for w in found) else 1, likely


def _marks(raw: str, tag: str, within: bool) -> tuple[int, bool, bool, bool, str]:
    """(not the article: 1 by a word, 2 for certain; likely the article; the words against it are all ambiguous; signed; the class), by an
    element's attributes."""
    if not raw.strip(" /\n\t"):
        return 0, False, False, False, ""
    unlikely, likely, sure, signed, named = 0, False, False, False, ""
    for m in _ATTRIBUTE.finditer(raw):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "class":
            named = value
            signed = signed or any(w in SIGNS for w in _WORD.findall(_CAMEL.sub("-", value).lower()))
        if name in ("class", "id", "role"):
            if name == "id" and tag in TEXTUAL or tag not in BLOCK and not value.isalpha():
                continue
            for part in _NAME.findall(value):
                no, yes = _says(part, tag, within)
                unlikely, likely = max(unlikely, no), likely or yes
                sure = sure or no and not set(_WORD.findall(_CAMEL.sub("-", part).lower())) & BOILERPLATE <= AMBIGUOUS
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            unlikely = 2
    return unlikely, likely, unlikely == 1 and not sure, signed, named


class _Open:
    """The open elements, with their places by tag, so that a scope is looked up without a walk."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def last(self, *tags: str) -> int:
        """The innermost open element of these tags; 0 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def first(self, after: int, *tags: str) -> int:
        """The outermost one of these tags inside the element at `after`; 0 if there is none."""
        places = [(p, bisect_right(p, after)) for t in tags if (p := self.at.get(t))]
        return min((p[k] for p, k in places if k < len(p)), default=0)

    def close(self, place: int) -> None:
        """Close the element at this place and all within it."""
        while len(self.stack) > place:
            tag = self.stack.pop().tag
            self.at[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()


def parse(html: str) -> Node:
    """The page as a tree; missing and stray end tags are mended. Every character and every element is looked at a bounded number of
    times, and a lookup among the open elements takes the logarithm of their number."""
    root = Node("html", None)
    open_ = _Open(root)
    here, end = 0, len(html)

    def text(chunk: str) -> None:
        # References end with their text: markup in the midst of one is not part of it.
        open_.stack[-1].children.append(unescape(chunk) if "&" in chunk else chunk)

    while here < end:
        m = _TOKEN.search(html, here)
        if not m:
            text(html[here:])
            break
        if m.start() > here:
            text(html[here : m.start()])
        here = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            place = open_.last(tag)
            if tag == "br":
                open_.stack[-1].children.append(" ")
            elif place and tag not in ("html", "body"):
                # The end of an inline element does not end the blocks that were opened within it.
                if tag in BLOCK or not open_.blocks or open_.blocks[-1] < place:
                    open_.close(place)
            elif tag == "p":
                open_.stack[-1].children.append(Node("p", open_.stack[-1]))
            continue
        if tag in ("html", "body", "head") and (tag == "html" or open_.last(tag)):
            continue
        if tag in BLOCK and (place := open_.last("p")):
            open_.close(place)
        if tag in _ENDS and (place := open_.first(open_.last(*_SCOPE[tag]), *_ENDS[tag])):
            open_.close(place)
        at = open_.stack[-1]
        if tag == "br" or tag == "wbr":
            at.children.append(" " if tag == "br" else "")
            continue
        if tag in RAW:
            done = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, here)
            here = done.end() if done else end
            continue
        code = open_.last("pre", "code") > 0  # what is marked there are parts of a program
        within = open_.last("article", "main") > 0
        node = Node(tag, at, *((0, False, False, False, "") if code else _marks(m[3], tag, within)))
        if tag == "form" or tag == "header" and not within or tag == "footer" and at.tag != "blockquote":
            node.unlikely, node.unsure = max(node.unlikely, 1), False
        at.children.append(node)
        if tag not in VOID and not (m[3].endswith("/") and tag not in BLOCK and tag not in ("a", "b", "i", "em", "strong", "span")):
            open_.push(node)
    return root


def _dropped(node: Node) -> bool:
    return node.tag in DROPPED or node.unlikely > 0 and node.tag not in ("html", "body")


def _overrule(root: Node) -> None:
    """Boilerplate words, and a form or header around the article, no longer count where the part holds much of the text of the page,
    and the article where that is marked."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node) and (c.unlikely == 1 and c.tag not in DROPPED or not _dropped(c))]
    if not any(n.unlikely for n in order):
        return
    text, holds = {}, set()
    for node in reversed(order):
        if node.tag in ("article", "main") or any(id(c) in holds for c in node.children):
            holds.add(id(node))
        text[id(node)] = 0 if node.tag == "a" else sum(len(c.strip()) if isinstance(c, str) else text.get(id(c), 0) for c in node.children)
    for node in order:
        if node.unlikely == 1 and text[id(node)] and node.tag != "footer" and (id(node) in holds or not holds):
            if node.tag in ("form", "header"):
                share = 0.0 if id(node) in holds else OVERRULED_WHOLE
            else:
                share = OVERRULED_LIKELY if node.likely else OVERRULED
            if text[id(node)] >= share * text[id(root)]:
                node.unlikely = 0


def _settle(root: Node) -> None:
    """Parts whose ambiguous name their structure does not bear out stay: low in links, without controls, with a paragraph of their own."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    if not any(n.unsure for n in order):
        return
    found: dict[int, tuple[int, int, bool, bool]] = {}
    for node in reversed(order):
        chars = links = 0
        paragraph, control = node.tag in ("p", "pre", "blockquote"), node.tag in ("form", "input", "button", "select", "textarea")
        for c in node.children:
            if isinstance(c, str):
                chars += len(c.strip())
            else:
                own = found[id(c)]
                chars, links, paragraph, control = chars + own[0], links + own[1], paragraph or own[2], control or own[3]
        found[id(node)] = chars, chars if node.tag == "a" else links, paragraph, control
        if node.unsure and node.unlikely == 1 and paragraph and not control and links < MOST_LINKS * chars:
            node.unlikely = 0


def _comment_runs(root: Node) -> None:
    """A container most of whose parts are of one make, two at least, each signed, goes where enough text stands before it and no article
    or main part in it."""
    order = list(_walk(root))
    text, signed, marked = {}, {}, {}
    for node in reversed(order):
        kids = [c for c in node.children if isinstance(c, Node) and id(c) in text]
        text[id(node)] = sum(len(c.strip()) for c in node.children if isinstance(c, str)) + sum(text[id(c)] for c in kids)
        signed[id(node)] = node.signed or any(signed[id(c)] for c in kids)
        marked[id(node)] = node.tag in ("article", "main") or any(marked[id(c)] for c in kids)
    before, gone = 0, set()
    for node in order:
        if node.parent is not None and id(node.parent) in gone:
            gone.add(id(node))
            continue
        kids = [c for c in node.children if isinstance(c, Node) and c.tag in BLOCK and id(c) in text]
        makes: dict[tuple[str, str], int] = {}
        for c in kids:
            if c.name and signed[id(c)]:
                makes[c.tag, c.name] = makes.get((c.tag, c.name), 0) + 1
        most = max(makes.values(), default=0)
        if most >= 2 and most * 5 >= len(kids) * 4 and before >= BEFORE_COMMENTS and node.tag in BLOCK and node.tag not in ("article", "main", "body", "table", "tbody", "tr") and not marked[id(node)]:
            node.unlikely = 2
            gone.add(id(node))
            continue
        before += sum(len(c.strip()) for c in node.children if isinstance(c, str))


def _squeeze(text: str) -> str:
    return " ".join(text.split())


def _walk(root: Node) -> Iterator[Node]:
    """Every element that stays, parents first."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not _dropped(c)]


def _measure(order: list[Node]) -> None:
    """Characters of text, and of text in links, of every element."""
    for node in reversed(order):
        node.chars = sum(len(c.strip()) for c in node.children if isinstance(c, str)) + sum(c.chars for c in node.children if isinstance(c, Node) and not _dropped(c))
        node.links = node.chars if node.tag == "a" else sum(c.links for c in node.children if isinstance(c, Node) and not _dropped(c))


def _own_text(node: Node) -> tuple[int, int]:
    """(length, commas) of the text that stands in this element and its inline parts."""
    chars = commas = 0
    stack = [node]
    while stack:
        for c in stack.pop().children:
            if isinstance(c, str):
                chars += len(c.strip())
                commas += sum(map(c.count, ",،、，"))
            elif c.tag not in BLOCK and not _dropped(c):
                stack.append(c)
    return chars, commas


def _density(node: Node) -> float:
    return node.links / node.chars if node.chars else 0.0


def _beside(parts: list[Node | str], least: float) -> list[Node | str | None]:
    """What is kept of these siblings, in page order; None ends a line. Text and inline elements that follow each other are one part;
    a heading goes with what it heads."""
    units: list[list[Node | str]] = []
    for c in parts:
        if isinstance(c, Node) and (c.tag in BLOCK or _dropped(c)):
            units.append([c])
        elif units and not (isinstance(units[-1][0], Node) and (units[-1][0].tag in BLOCK or _dropped(units[-1][0]))):
            units[-1].append(c)
        else:
            units.append([c])
    kept: list[list[Node | str]] = []
    heads = True  # whether what follows is kept; at the end, the best container or nothing
    for unit in reversed(units):
        first = unit[0]
        if isinstance(first, Node) and _dropped(first):
            heads = False
            continue
        chars = sum(len(c.strip()) if isinstance(c, str) else c.chars for c in unit)
        links = sum(c.links for c in unit if isinstance(c, Node))
        if not chars:
            continue
        if isinstance(first, Node) and first.tag in HEADINGS:
            if heads:
                kept.append(unit)
            continue
        scores = isinstance(first, Node) and first.tag in BLOCK and first.points >= least
        heads = scores or links < MOST_LINKS * chars
        if heads:
            kept.append(unit)
    return [c for unit in reversed(kept) for c in (None, *unit, None)]


def main_containers(root: Node) -> list[Node | str | None]:
    """The best container and what is kept beside it, in page order; None ends a line."""
    _settle(root)
    _overrule(root)
    _comment_runs(root)
    order = list(_walk(root))
    _measure(order)
    scored: dict[int, Node] = {}
    for node in order:
        if node.tag not in BLOCK:
            continue
        chars, commas = _own_text(node)
        if chars < 20:
            continue
        points = 1 + commas + min(chars / 100, 3)
        if node.tag in ("li", "dt", "dd") or node.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            points /= 3
        up, share = (node.parent if node.tag in ("p", "pre", "blockquote", "li", "dd", "dt", "td", "th", "figcaption") or node.tag[0] == "h" else node), 1.0
        for level in range(4):
            if up is None:
                break
            up.points += points * share
            scored[id(up)] = up
            up, share = up.parent, 0.5 if level == 0 else share / 2
    if not scored:
        marked = [n for n in order if n.tag in ("article", "main")] or [n for n in order if n.tag == "body"]
        return marked[:1] or [root]
    for n in scored.values():
        n.points = (n.points + (10 if n.tag in ("article", "main") else 5 if n.likely else 0)) * (1 - _density(n))
    best = max(scored.values(), key=lambda n: n.points)
    inner = best
    least = max(10.0, 0.2 * best.points)
    holders, above = {}, best
    while above is not None:
        kind = above.tag if above.tag in ("article", "main") else "likely" if above.likely and _density(above) < MOST_LINKS else ""
        holders[kind] = above  # the outermost of a kind
        above = above.parent
    top = next((holders[k] for k in ("article", "main", "likely") if k in holders), root)
    if "article" in holders:
        inner = top
    before: list[list] = []
    after: list[list] = []
    node = inner
    # Beside the best container, level by level up to the one that holds it; of a container that is only likely, beside that too.
    while node.parent is not None and (node is not top or top.tag not in ("article", "main")):
        at = next(i for i, c in enumerate(node.parent.children) if c is node)
        before.append(_beside(node.parent.children[:at], least))
        after.append(_beside(node.parent.children[at + 1 :], least))
        if node is top:
            break
        node = node.parent
    if top.tag in ("article", "main") and top.parent is not None:
        at = next(i for i, c in enumerate(top.parent.children) if c is top)
        for side, parts in ((before, top.parent.children[:at]), (after, top.parent.children[at + 1 :])):
            side.append([x for s in parts if isinstance(s, Node) and not _dropped(s) and (s.points >= least and s.tag != "a" or _reads(s) or s.tag == top.tag and s.chars and _density(s) < MOST_LINKS) for x in (None, s, None)])
    return [c for level in reversed(before) for c in level] + [None, inner, None] + [c for level in after for c in level]


def _reads(s: Node) -> bool:
    return s.tag == "p" and (s.chars >= 80 and _density(s) < 0.25 or 0 < s.chars < 80 and not s.links)


def extract(html: str | None) -> str:
    """The main text of a page: its blocks, white space within each squeezed, joined by one newline."""
    if not html:
        return ""
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if line:
            text = _squeeze("".join(line))
            line.clear()
            if text:
                blocks.append(text)

    for top in main_containers(parse(html)):
        stack: list = [top]
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                line.append(c)
            elif c is None:
                flush()
            elif c is top or not _dropped(c):
                block = c.tag in BLOCK
                if block:
                    flush()
                    stack.append(None)
                stack += reversed(c.children)
    flush()
    return "\n".join(blocks)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of pages.

    A null or empty page, and one without text, gives an empty text. Nothing is cut off, however long the page is. Repeated rows
    each get a row, a table without rows gives none, and columns other than the three named are not read."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            html = f["html"].fillna("").tolist()
            for a, b in slices(html, 16_000_000):
                text = [extract(h) for h in html[a:b]]
                yield pd.DataFrame({"page_id": f["page_id"].iloc[a:b], "url": f["url"].iloc[a:b], "text": pd.Series(text, f.index[a:b], object), "n_chars": pd.Series([len(t) for t in text], f.index[a:b], "int64")})

    return rows.mapInPandas(tidy(run), f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")


def op2_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
