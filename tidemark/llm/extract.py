"""Main text of HTML pages by two passes of block rules.

The markup is cut into blocks at block-level tags. The first pass decides what it can:
a block in a menu, header, footer, sidebar, notice, advert, form or comment section, or
made of links, is boilerplate; a long block, or one with many stop words, is text. The
second pass gives each undecided short block the label of its nearest decided
neighbours. On a page that has an <article> or <main>, only blocks inside it can be
text, and the densities decide between its blocks.

An element that is boilerplate by its tag (a menu, a footer) or hidden is so for certain. One
that is so by its class, id, role or as a form is not, if it holds all the <article> and
<main> of its page, or most of the text of a page that has none; comments always are.
Running text is told by stop words of four languages, or by the short words of its
sentences in any other; scripts without blanks are told by their signs. On a page
without <article> and <main> where nothing is text by these rules, all that is neither
boilerplate nor links is.
"""

from __future__ import annotations

import html as _html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map

# Tag names, name hints and stop words.
BLOCK_TAGS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul caption".split()
)
RAW_TAGS = set("script style noscript template iframe svg math object textarea head title".split())
BOILERPLATE_TAGS = set("nav footer aside menu dialog button select".split())
#: Boilerplate outside the article, part of it inside.
PAGE_TAGS = {"header"}
CONTENT_TAGS = {"article", "main"}
VOID_TAGS = set("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
_P_ENDS = "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul"
#: Elements whose end tag may be left out, and the tags that then end them.
ENDED_BY = {
    "p": set(_P_ENDS.split()), "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "optgroup": {"optgroup"},
    "td": set("td th tr tbody tfoot thead".split()), "th": set("td th tr tbody tfoot thead".split()), "tr": set("tr tbody tfoot thead".split()),
    "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "tfoot": {"tbody", "thead"}, "caption": set("col colgroup tbody tfoot thead tr".split()),
}
#: Elements inside which such a tag belongs to another, inner one.
SCOPES = {"p": {"button", "object"}, "li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"}, "optgroup": {"select"}} | dict.fromkeys("td th tr thead tbody tfoot caption".split(), {"table"})
#: The elements that a start tag may end.
ENDS = {tag: [k for k, tags in ENDED_BY.items() if tag in tags] for tag in set().union(*ENDED_BY.values())}
TABLE_TAGS = set("table thead tbody tfoot tr td th caption".split())
CELLS = {"table", "td", "th", "caption"}
HINTS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidenav menu nav navbar "
    "navigation breadcrumb breadcrumbs footer cookie cookies consent notice notices alert popup modal overlay newsletter subscribe "
    "subscription share sharing social related recommended recommendations comment comments reply replies respond disqus widget login "
    "signup toolbar pagination pager copyright disclaimer teaser".split()
)
COMMENT_HINTS = set("comment comments reply replies respond disqus".split())
#: A hint after one of these says what an element lacks or is beside of.
DENIALS = set("no not non has have with without hide".split())
PAGE_HINTS = {"header", "masthead", "topbar"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
STOP_WORDS = set(
    # English, German, French, Spanish
    "the of and to in is a that for it as was with be by on not he his but at are this have from or which you an were "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "de la le les et des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son aux ou "
    "el los del las con para una su lo como más pero sus al fue este ha y o no".split()
)

SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.15, 0.30
LINKS_BAD = 0.5
#: Of the text outside menus and the like, the share that a doubtful element of a page without <article> must exceed to be its text.
MOST = 2 / 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
#: An attribute: its name and, as one of three, its value.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_PARTS = re.compile(r"[^a-z]+")
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?…։؟।]['\"»”)\]]*(?:\s|\Z)")
#: Letters of scripts that put no blanks between words: Thai to Burmese, Khmer, kana, ideographs.
_DENSE = re.compile(r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF]")


@dataclass
class Block:
    text: str
    linked: int
    links: int
    heading: bool
    inside: bool
    regions: tuple[int, ...]
    boilerplate: bool = False
    label: str = "?"


@dataclass
class _Region:
    """An element that may be boilerplate: for certain, or as long as it does not hold the page's text."""

    depth: int
    certain: bool
    comment: bool
    contents: int = 0


def _hints(value: str) -> set[str]:
    parts = [x for x in _PARTS.split(value) if x]
    return {x for x, before in zip(parts, ["", *parts]) if before not in DENIALS}


def _region(name: str, rest: str, inside: bool, depth: int) -> _Region | None:
    """The region that an element opens by its tag or its class, id and role."""
    if name in BOILERPLATE_TAGS or (name in PAGE_TAGS and not inside):
        return _Region(depth, True, False)
    found = _Region(depth, False, False) if name == "form" else None
    if not rest or name in ("html", "body", "a"):
        return found
    for kind, *values in _ATTRIBUTE.findall(rest):
        kind, value = kind.lower(), next((v for v in values if v), "").lower()
        if kind == "hidden" or (kind == "aria-hidden" and value.startswith("true")) or (kind == "style" and _NO_DISPLAY.search(value)):
            return _Region(depth, True, False)
        if kind == "role" and value in ROLES and name not in CONTENT_TAGS:
            found = found or _Region(depth, False, False)
        elif kind in ("class", "id"):
            parts = _hints(value)
            if parts & COMMENT_HINTS:
                found = _Region(depth, False, True)
            elif name not in CONTENT_TAGS and (parts & HINTS or (parts & PAGE_HINTS and not inside)):
                found = found or _Region(depth, False, False)
    return found


class _Open:
    """The open elements, outermost first; end tags that may be left out are added."""

    def __init__(self):
        self.names: list[str] = []
        self.at: dict[str, list[int]] = {}  # places of each name, and of all blocks under ""

    def _last(self, names) -> int:
        return max((self.at[x][-1] for x in names if self.at.get(x)), default=-1)

    def push(self, name: str) -> None:
        for key in (name, "") if name in BLOCK_TAGS else (name,):
            self.at.setdefault(key, []).append(len(self.names))
        self.names.append(name)

    def cut(self, depth: int) -> None:
        while len(self.names) > depth:
            name = self.names.pop()
            for key in (name, "") if name in BLOCK_TAGS else (name,):
                self.at[key].pop()

    def count(self, names) -> int:
        return sum(len(self.at.get(x, ())) for x in names)

    def after_start(self, name: str) -> int:
        """How many elements stay open before ``name`` begins."""
        ended = [self.at[x][-1] for x in ENDS.get(name, ()) if self.at.get(x) and self.at[x][-1] > self._last(SCOPES[x])]
        return min(ended, default=len(self.names))

    def after_end(self, name: str) -> int:
        """How many elements stay open after the end tag of ``name``; one that fits no open element ends none."""
        i = self._last((name,))
        bars = SCOPES.get(name, set()) if name in TABLE_TAGS else SCOPES.get(name, set()) | CELLS if name in BLOCK_TAGS else {""}
        return i if i >= 0 and i > self._last(bars - {name}) else len(self.names)


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, white space made single, character references decoded."""
    out: list[Block] = []
    held: list[str] = []
    linked = links = inside = contents = 0
    regions: list[_Region] = []
    active: list[int] = []  # regions that hold the place we are at, outermost first
    opened, heading, at = _Open(), False, 0
    link: int | None = None  # the place of the open link

    def flush():
        nonlocal linked, links
        if held:
            text = " ".join(_html.unescape("".join(held)).split())
            if text:
                out.append(Block(text, linked, links, heading, inside > 0, tuple(active)))
            held.clear()
        linked = links = 0

    while m := _TOKEN.match(page, at):
        at = m.end()
        if (text := m["text"]) is not None:
            held.append(text)
            if link is not None:
                linked += len(" ".join(text.split()))
            continue
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name, rest, close = name.lower(), m["rest"] or m["rest2"] or "", bool(m["close"] or m["close2"])
        if name in BLOCK_TAGS or name in RAW_TAGS:
            flush()
        elif name == "br":
            held.append(" ")
        if name in RAW_TAGS and not close and not rest.endswith("/"):
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            body = re.compile(r"<body\b", re.I).search(page, at) if name == "head" and not end else None
            # a head that nothing ends: what belongs to it is skipped tag by tag
            at = end.end() if end else body.start() if body else at if name == "head" else len(page)
            continue
        if name[0] == "h" and len(name) == 2 and name[1].isdigit():
            heading = not close
        depth = opened.after_end(name) if close else opened.after_start(name)
        if active and depth <= regions[active[-1]].depth:
            flush()
            while active and depth <= regions[active[-1]].depth:
                active.pop()
        if depth < len(opened.names):
            opened.cut(depth)
            inside = min(inside, opened.count(CONTENT_TAGS))
        if link is not None and (len(opened.names) <= link or (close and name == "a")):
            link = None
        if close or name in VOID_TAGS or rest.endswith("/"):
            continue
        if name == "a" and any(kind.lower() == "href" for kind, *_ in _ATTRIBUTE.findall(rest)):
            link = len(opened.names)
            links += 1
        if region := _region(name, rest, inside > 0, len(opened.names)):
            flush()
            active.append(len(regions))
            regions.append(region)
        if name in CONTENT_TAGS:
            if not any(regions[r].certain or regions[r].comment for r in active):
                contents += 1
                for r in active:
                    regions[r].contents += 1
            inside += 1
        opened.push(name)
    flush()
    _decide(out, regions, contents)
    return out


def _decide(found: list[Block], regions: list[_Region], contents: int) -> None:
    """Which regions, hence which blocks, are boilerplate."""
    known = [any(regions[r].certain or regions[r].comment for r in b.regions) for b in found]
    size = [0] * len(regions)
    total = 0
    for b, out in zip(found, known):
        if not out:
            total += len(b.text) - b.linked
            for r in b.regions:
                size[r] += len(b.text) - b.linked
    holds = [(r.contents == contents if contents else n > MOST * total) for r, n in zip(regions, size)]
    for b, out in zip(found, known):
        b.boilerplate = out or any(not holds[r] for r in b.regions)


def _running(text: str) -> float:
    """The share of stop words, or of short words where there are sentences: running text has many of them."""
    if len(_DENSE.findall(text)) > 0.3 * len(text):
        return 1.0
    words = _WORD.findall(text.lower())
    listed = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
    short = sum(len(w) <= 3 for w in words) / max(len(words), 1) if _SENTENCE.search(text) else 0.0
    return max(listed, short)


def _length(text: str) -> int:
    """Characters; a letter of a script without blanks is as long as three."""
    return len(text) + 2 * len(_DENSE.findall(text))


def _first_pass(found: list[Block], framed: bool) -> None:
    for b in found:
        n = _length(b.text)
        density = b.linked / len(b.text)
        if b.boilerplate or (framed and not b.inside):
            b.label = "boilerplate"
        elif density > LINKS_BAD and (b.links > 1 or not b.inside):
            b.label = "boilerplate"
        else:
            stop = _running(b.text)
            if framed:
                if density <= LINKS_BAD and (n >= LONG or n >= SHORT and stop >= STOP_LOW):
                    b.label = "text"
            elif n >= LONG and stop >= STOP_LOW or n >= SHORT and stop >= STOP_HIGH:
                b.label = "text"
            elif n >= LONG:
                b.label = "unlike text"


def _second_pass(found: list[Block], framed: bool) -> None:
    """Undecided blocks take the label of their nearest decided neighbours.

    Where the two sides differ or are missing, a heading follows the block after it, a
    block of a framed page is text, and any other is boilerplate. Distances count blocks.
    """
    n = len(found)
    before, after = [None] * n, [None] * n
    last = None
    for i in range(n):
        if found[i].label != "?":
            last = i
        before[i] = last
    last = None
    for i in range(n - 1, -1, -1):
        if found[i].label != "?":
            last = i
        after[i] = last
    given = {}
    for i, b in enumerate(found):
        if b.label != "?":
            continue
        sides = [(abs(i - j), found[j].label) for j in (before[i], after[i]) if j is not None and (not framed or found[j].inside and not found[j].boilerplate)]
        if not sides:
            given[i] = "text" if framed else "boilerplate"
        elif len({x for _, x in sides}) == 1:
            given[i] = sides[0][1]
        elif b.heading:
            given[i] = sides[-1][1]
        elif framed:
            given[i] = "text"
        else:
            given[i] = min(sides)[1] if sides[0][0] != sides[1][0] else "boilerplate"
    for i, label in given.items():
        found[i].label = label


def main_text(page: str | None) -> str:
    """The text blocks joined by blank lines; empty for a null page or one without text."""
    if not page:
        return ""
    found = blocks(page)
    framed = any(b.inside and not b.boilerplate for b in found)
    _first_pass(found, framed)
    if not framed and not any(b.label == "text" for b in found):
        rest = [b for b in found if b.label in ("?", "unlike text")]
        if "<" in page or sum(len(b.text) for b in rest) >= SHORT:
            for b in rest:
                b.label = "text"
    for b in found:
        if b.label == "unlike text":
            b.label = "boilerplate"
    _second_pass(found, framed)
    return "\n\n".join(b.text for b in found if b.label == "text")


def extracted(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row.

    A null page is empty; text that ends inside a tag or a comment ends there; repeated
    rows, null ids and an empty table are kept as they are; other columns are not looked at.
    """

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [main_text(p) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:2])
    return arrow_map(source, run, f"{kinds}, text string, n_chars bigint")
