"""Operator 5: main text of web pages by tree scoring.

Each page is parsed into a tree of elements with blocks of text. A block gives
points for its length and its commas, discounted by its share of link text, to
the containers above it, half as many at each level. From the best container
the way up is followed as long as text stands beside it; the last one and those
of its siblings that read like it are kept, without the furniture inside them.
Pages are independent, so the operator is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.store import col, row_schema

# Quotes count only after "=": a lone one is part of a name or a value. The
# groups are possessive, so no text is looked at again and again.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTR = re.compile(r"([a-zA-Z][-\w:]*+)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?")
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe textarea title svg object select canvas".split())
BLOCK = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul caption".split()
)
#: Open elements that a start tag closes, up to the nearest scope element.
CLOSES = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
SCOPE = frozenset("html body table ul ol dl div article section aside nav main header footer form blockquote td th".split())
FURNITURE = frozenset("nav aside footer form button menu dialog head search".split())
FURNITURE_ROLE = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar note".split()
)
# Names of furniture, as the last or only part of a class or id ("left-sidebar",
# "ad_slot"). A strong one drops a container unless it holds the page; a weak one
# drops it only if it doesn't read like prose of the article around it.
_STRONG = re.compile(
    r"(?:ads?|adsby\w+|advert\w*|adsense|adslot|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|alerts?|"
    r"popups?|modal|overlay|newsletter|subscri\w*|signup|login|sidebars?|widgets?|nav|navbar|navigation|menus?|"
    r"breadcrumbs?|footers?|masthead|topbar|toolbar|comments?|commentlist|disqus\w*|respond|repl(?:y|ies)|responses|"
    r"pagination|pager|paging|skip|outbrain|taboola|paywall|(?:site|page|global|top)[_-]?(?:header|nav|footer))",
    re.IGNORECASE,
)
_WEAK = re.compile(r"(?:side|discussion|related|recommend\w*|share|sharing|social|tags)", re.IGNORECASE)
# What may follow such a name in a class ("ad-slot", "comments-area").
_PLACE = re.compile(
    r"(?:slot|box|area|wrap(?:per)?|container|section|block|list|link|links|bar|unit|text|title|content|inner|outer|"
    r"main|top|bottom|left|right|primary|secondary|posts?|articles?|items?|stories|form|icons?|buttons?|\d+)",
    re.IGNORECASE,
)
# Before a name, these say something about the page or its subject, not what the container is.
_STATE = frozenset("has no not with without is in on tag category cat topic type format status post page js hide show".split())
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_MAIN_NAME = re.compile(r"(?:^|[\s_-])(?:article|post|entry|content|story|main|text|body)(?:$|[\s_-])", re.IGNORECASE)


def suspicion(label: str) -> int:
    """How surely a class or id names furniture: 0, 1 (weak) or 2 (strong)."""
    found = 0
    for name in label.split():
        if _STRONG.fullmatch(name):
            return 2
        parts = [p for p in re.split(r"[_-]+", name) if p]
        if len(parts) > 1 and parts[0].lower() in _STATE:
            continue
        while len(parts) > 1 and _PLACE.fullmatch(parts[-1]) and not _STRONG.fullmatch(parts[-1]):
            parts.pop()
        if parts and _STRONG.fullmatch(parts[-1]):
            return 2
        if parts and _WEAK.fullmatch(parts[-1]):
            found = 1
    return found


class Element:
    __slots__ = ("name", "parent", "children", "furniture", "suspect", "bonus", "score", "text", "main", "head", "in_main",
                 "first", "last")

    def __init__(self, name: str, parent: "Element | None", attrs: str = ""):
        self.name, self.parent = name, parent
        self.children: list[Element | tuple[str, int]] = []
        self.score, self.text, self.bonus, self.main = 0.0, 0.0, 0.0, name in ("article", "main")
        self.furniture, self.head, self.suspect = name in FURNITURE, name == "header", 0
        self.in_main = parent is not None and (parent.in_main or parent.main)
        if attrs and not attrs.isspace():
            given = {k.lower(): unescape(v.strip("\"'")) for k, v in _ATTR.findall(attrs)}
            label = f"{given.get('class', '')} {given.get('id', '')}"
            role = given.get("role", "").lower()
            self.head = self.head or "header" in label.lower().split()
            self.main = self.main or role in ("main", "article")
            if name not in ("html", "body") and not self.main:
                self.suspect = suspicion(label)
            elif name == "article" and re.search(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies))(?:$|[\s_-])", label, re.I):
                self.furniture, self.main = True, False
            self.furniture = (
                self.furniture or role in FURNITURE_ROLE or "hidden" in given
                or given.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN_STYLE.search(given.get("style", "")))
            )
            if name not in ("html", "body") and _MAIN_NAME.search(label):
                self.bonus = 5.0
        if self.head and not self.furniture:  # of the site, unless the article's own
            self.furniture = not self.in_main
        if self.main:
            self.bonus += 10.0


def _above(element: Element | None) -> Iterator[Element]:
    while element is not None:
        yield element
        element = element.parent


def parse(html: str) -> Element:
    """The tree of a page; children are elements and blocks (text, link characters).

    Missing end tags are closed by what can't lie inside, stray ones ignored.
    """
    root = Element("html", None)
    here, links, at = root, 0, 0
    words: list[str] = []
    inside_link: list[str] = []
    unclosed: set[str] = set()  # names of which no end tag follows
    # Names of the elements above, and of those inside the nearest article or main.
    opened: Counter[str] = Counter()
    inside: list[Counter[str]] = [Counter()]

    def past_end(name: str) -> int | None:
        """The place behind the next end tag of ``name``."""
        if name in unclosed:
            return None
        end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+>", re.IGNORECASE).search(html, at)
        if end is None:
            unclosed.add(name)
        return end and end.end()

    def end_block() -> None:
        nonlocal links
        text = _SPACE.sub(" ", unescape("".join(words))).strip()
        if text:
            linked = len(_SPACE.sub(" ", unescape("".join(inside_link))).strip())
            here.children.append((text, min(linked, len(text))))
        words.clear()
        inside_link.clear()

    def add(text: str) -> None:
        if text:
            if here.name == "head" and not text.isspace():
                leave(here)
            words.append(text)
            if links:
                inside_link.append(text)

    def leave(element: Element) -> None:
        """Go on in the parent of ``element``, one of those above."""
        nonlocal here
        while here is not element.parent:
            opened[here.name] -= 1
            if here.name in ("article", "main"):
                inside.pop()
            else:
                inside[-1][here.name] -= 1
            here = here.parent

    def close(names: set[str], until: frozenset[str]) -> None:
        if not any(opened[n] for n in names):
            return
        for e in _above(here):
            if e.name in names and e.parent is not None:
                leave(e)
                return
            if e.name in until:
                return

    while found := _TOKEN.search(html, at):
        add(html[at : found.start()])
        at = found.end()
        if found["name"] is None:
            continue
        name, attrs = found["name"].lower(), found["attrs"]
        if name in RAW:
            if not found["close"] and not attrs.rstrip().endswith("/"):
                at = past_end(name) or (len(html) if name in ("script", "style") else at)
                add(" ")
        elif name == "a":
            links = 0 if found["close"] else 1
        elif name == "br":
            add(" ")
        elif name in BLOCK or name in FURNITURE:
            end_block()
            if name == "hr":
                continue
            if found["close"]:
                for e in _above(here) if (opened if name in SCOPE else inside[-1])[name] else ():
                    if e.name == name:
                        leave(e)
                        links = 0
                        break
                continue
            if here.name == "head":  # its end tag is left out
                leave(here)
            if name in ("html", "body"):
                continue
            close(CLOSES.get(name, set()) | {"p"}, SCOPE - CLOSES.get(name, set()))
            here.children.append(child := Element(name, here, attrs))
            if not attrs.rstrip().endswith("/") or name in BLOCK:
                here = child
                opened[name] += 1
                if name in ("article", "main"):
                    inside.append(Counter())
                else:
                    inside[-1][name] += 1
        elif not found["close"] and name not in VOID and attrs.strip():
            # Inline elements take no part in the tree unless they are furniture.
            inline = Element(name, here, attrs)
            if inline.furniture or inline.suspect == 2:
                at = past_end(name) or at
    add(html[at:])
    end_block()
    _weigh(root)
    return root


#: A weak name does not drop a container inside an article of so many
#: characters outside of links, nor of less than this share of link text.
PROSE_CHARS, PROSE_LINKS = 140, 0.25


def _weigh(root: Element) -> None:
    """Decide which containers of suspicious names are furniture.

    None that holds a main element of some text is; one of a strong name stays
    if the rest of the page has no main element and under a quarter of its
    text, one of a weak name inside a main element if it reads like prose.
    """
    order, stack = [], [root]
    while stack:
        e = stack.pop()
        order.append(e)
        stack += [c for c in e.children if isinstance(c, Element) and not c.furniture]
    plain: dict[Element, tuple[int, int, bool]] = {}  # characters, those in links, holds a main element
    for e in reversed(order):
        size = linked = 0
        main = False
        for c in e.children:
            if isinstance(c, tuple):
                size, linked = size + len(c[0]), linked + c[1]
            elif c in plain:
                n, k, m = plain[c]
                size, linked, main = size + n, linked + k, main or m
        plain[e] = size, linked, main or (e.main and size > linked)
    total, total_links, has_main = plain[root]
    for e in order:
        if not e.suspect:
            continue
        size, linked, main = plain[e]
        own = size - linked
        if main:
            continue
        if not has_main and own > 0.75 * (total - total_links):
            continue
        e.furniture = not (e.suspect == 1 and e.in_main and own >= PROSE_CHARS and linked < PROSE_LINKS * size)


def _blocks(element: Element) -> Iterator[tuple[str, int]]:
    """Blocks in page order, without furniture; no recursion, trees may be deep."""
    stack = [iter(element.children)]
    while stack:
        for child in stack[-1]:
            if isinstance(child, tuple):
                yield child
            elif not child.furniture:
                stack.append(iter(child.children))
                break
        else:
            stack.pop()


def _score(root: Element) -> list[Element]:
    """Score all containers; returns those that got points.

    ``score`` halves at each level, ``text`` is the undivided sum.
    """
    order, stack, held = [], [root], set()
    while stack:
        e = stack.pop()
        order.append(e)
        for child in e.children:
            if isinstance(child, Element):
                if not child.furniture:
                    stack.append(child)
                continue
            text, linked = child
            points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))
            holder = e if e.name not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre") else e.parent
            holder.score += points
            e.text += points
            held.add(holder)
    for at, e in enumerate(order):
        e.first = e.last = at
    for e in reversed(order[1:]):  # whatever lies below has been added
        e.parent.last = max(e.parent.last, e.last)
        e.parent.score += e.score / 2
        e.parent.text += e.text
        if e in held:
            held.add(e.parent)
    scored = [e for e in order if e in held]
    for e in scored:
        e.score += e.bonus
    return scored


def _best(scored: list[Element]) -> Element:
    """The main element with most text below it, or the one inside that holds
    most of this; without any, the container of the highest score."""
    marked = [e for e in scored if e.main and e.text > 0]
    if not marked:
        return max(scored, key=lambda e: e.score)
    best = max(marked, key=lambda e: e.text)
    for e in marked:  # outer ones come first
        if e.text > best.text / 2 and best.first < e.first <= best.last:
            best = e
    return best


def _climbed(best: Element) -> Element:
    """The highest container above ``best`` with text beside the way to it."""
    top, way = best, best
    while way.parent is not None and way.parent.parent is not None:
        if any(
            e is not way and (e[1] < 0.25 * len(e[0]) if isinstance(e, tuple) else not e.furniture and _reads(e))
            for e in way.parent.children
        ):
            top = way.parent
        way = way.parent
    return top


def main_text(html: str | None) -> str:
    """Blocks of the main content, one a line; empty if there is none."""
    root = parse(html or "")
    scored = _score(root)
    if not scored:
        return ""
    best = _best(scored)
    beside = best
    if not best.main:
        beside = best = _climbed(best)
        while beside.parent is not None and beside.parent.parent is not None:
            beside = beside.parent
    kept = [best]
    if beside.parent is not None:
        least = max(10.0, best.score * 0.2, best.text * 0.2)
        kept = [
            best if e is beside else e for e in beside.parent.children
            if e is beside or isinstance(e, Element) and not e.furniture and (
                e.score >= least or not best.main and (e.name in ("h1", "h2", "h3") or _reads(e))
            )
        ]
    return "\n".join(text for e in kept for text, _ in _blocks(e))


def _reads(element: Element) -> bool:
    blocks = list(_blocks(element))
    n, linked = (sum(x) for x in ((len(t) for t, _ in blocks), (k for _, k in blocks)))
    return n > 0 and linked / n < 0.25


def extract(
    pages: DataFrame, html_col: str = "html", text_col: str = "text"
) -> DataFrame:
    """All rows of ``pages`` with ``html_col`` replaced by ``text_col`` and
    ``n_chars``, its code points; other columns named like them are replaced.

    Null, empty and text-free html give the empty text. Character references
    are decoded, white space inside a block is one blank, blocks are joined by
    a line break. Repeated rows and null ids are rows like any other.
    """
    others = [c for c in pages.columns if c not in (html_col, text_col, "n_chars")]
    packed = pages.select(col(html_col).alias("html"), F.struct(*[col(c) for c in others], F.lit(0).alias("_")).alias("row"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["row", "text", "n_chars"],
            )

    out = packed.mapInArrow(read, row_schema(packed, "text string, n_chars long"))
    return out.select(*[F.col("row").getField(c).alias(c) for c in others], F.col("text").alias(text_col), "n_chars")
