"""A small, forgiving reader of HTML pages: elements, their generalised paths
and the text blocks below them. It knows which end tags may be missing, which
elements hold no text, and which parts of a page are not its article."""

from __future__ import annotations

import re
from collections.abc import Iterable
from html import unescape

import xxhash

# Markup: comments and raw-text elements as a whole, then tags; an unclosed
# comment, script or style runs to the end of the page.
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(script|style|noscript|template|iframe|svg|math|object|textarea|select|title|head(?=[\s>]))\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z!?][^>]*(?:>|$)",
    re.DOTALL | re.IGNORECASE,
)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_DIGITS = re.compile(r"[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article body center div html main section table tbody td tr".split())
# An open element that a start tag ends, unless one of the stoppers is met first.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
_P_STOPS = frozenset("body html div td th li article section main table button form blockquote".split())
# Elements that never belong to an article's text, by tag.
APART = frozenset("nav footer aside form button label input dialog menu".split())
# Words of class and id that speak for something else than an article's text. They
# are evidence only, see _settle.
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright"
    " disclaimer disqus footer foot gdpr header hidden legal login masthead menu modal nav navbar navigation newsletter notice notices notification pager"
    " pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored"
    " subscribe tags teaser toolbar topbar widget widgets".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
# Of these, words that name nothing else when they stand alone or with words of layout.
PLAIN_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies disqus gdpr login"
    " modal nav navbar navigation newsletter pager pagination popup promo promoted promotion sidebar signup sponsor sponsored subscribe".split()
)
LAYOUT_WORDS = frozenset("area bar block bottom box column container global group inner item left line link links list main outer page panel right row section site slot top unit wrap wrapper zone".split())
PAGE_TAGS = ("#", "html", "body")
ROLES = frozenset("banner complementary contentinfo dialog form navigation search".split())


class Element:
    __slots__ = ("tag", "parent", "path", "apart", "plain", "weak", "comment", "own", "links", "article", "blocks")

    def __init__(self, tag, parent, path, apart, plain=False, weak=False, comment=False):
        self.tag, self.parent, self.path, self.apart = tag, parent, path, apart
        self.plain, self.weak, self.comment = plain, weak, comment
        self.own = self.links = 0  # characters of text below, and of these in links
        self.article = tag in ("article", "main")
        self.blocks = []


def _label(tag: str, attrs: str) -> tuple[str, bool, bool, bool, bool]:
    """Generalised name of an element (tag and class, numbers as #); whether tag or
    attributes set it apart from an article; whether its words plainly say that it is
    apart, whether some of them do; and whether they name comments."""
    if not attrs or "=" not in attrs:
        return tag, tag in APART or (bool(attrs) and " hidden" in attrs.lower()), False, False, False
    name, apart, plain, weak, comment = tag, tag in APART, False, False, False
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), a or b or c
        if key == "class":
            name = f"{tag}.{'.'.join(sorted(set(_DIGITS.sub('#', value).split())))}"
        if key in ("class", "id"):
            for token in value.split():
                words = {w.lower() for w in _WORD.findall(token)}
                if words.isdisjoint(APART_WORDS) or not words.isdisjoint(("with", "has", "no")):
                    continue
                weak = True
                if not words.isdisjoint(PLAIN_WORDS) and words <= APART_WORDS | LAYOUT_WORDS:
                    plain, comment = True, comment or not words.isdisjoint(COMMENT_WORDS)
        elif (key == "style" and _HIDDEN.search(value)) or (key == "aria-hidden" and value == "true") or (key == "role" and value.lower() in ROLES):
            apart = True
    return name, apart, plain, weak, comment


def parse(html: str) -> tuple[list[Element], list[tuple[Element, list[str], int]]]:
    """Elements in page order, and the blocks: (element, its pieces of text with
    references decoded, characters of these in links)."""
    root = Element("#", None, "", False)
    elements, blocks = [root], []
    stack = [root]
    pieces: list[str] = []
    at, lower, link, linked = 0, None, 0, 0

    def close_block():
        nonlocal pieces, linked
        if pieces:
            blocks.append((stack[-1], pieces, linked))
            pieces, linked = [], 0

    def text(raw: str):
        nonlocal linked
        if raw:
            s = unescape(raw) if "&" in raw else raw
            pieces.append(s)
            n = len(s) - s.count(" ")
            top = stack[-1]
            top.own += n
            if link:
                top.links += n
                linked += n

    def pop_to(i: int):
        nonlocal link
        for e in stack[i:]:
            link -= e.tag == "a"
        if any(e.tag in BLOCK for e in stack[i:]):
            close_block()
        del stack[i:]

    for m in _TOKEN.finditer(html):
        if m.start() < at:
            continue
        text(html[at : m.start()])
        at = m.end()
        raw, end, tag = m.group(1), m.group(2), m.group(3)
        if raw:
            # Skip to the matching end tag; a head without one ends at the body.
            lower = lower if lower is not None else html.lower()
            tag = raw.lower()
            stop = lower.find(f"</{tag}", at)
            if tag == "head":
                body = lower.find("<body", at)
                stop = body if stop < 0 or 0 <= body < stop else stop
                if stop < 0:
                    continue
            if stop < 0:
                at = len(html)
                break
            at = stop if lower.startswith("<body", stop) else lower.find(">", stop) + 1 or len(html)
            continue
        if not tag:
            continue
        tag = tag.lower()
        if end:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    pop_to(i)
                    break
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCK:
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[i].tag == "p":
                    pop_to(i)
                    break
                if stack[i].tag in _P_STOPS:
                    break
            if tag in _ENDS:
                closes, stops = _ENDS[tag]
                hit = 0
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in stops:
                        break
                    if stack[i].tag in closes:
                        hit = i
                if hit:
                    pop_to(hit)
            close_block()
        if tag in VOID:
            continue
        parent = stack[-1]
        name, apart, *words = _label(tag, m.group(4))
        e = Element(tag, parent, f"{parent.path}>{name}" if tag in BLOCK else parent.path, apart, *words)
        elements.append(e)
        link += tag == "a"
        stack.append(e)  # the slash of <tag/> means nothing in HTML
    text(html[at:])
    close_block()
    return elements, blocks


def _sums(elements: list[Element], own: list[tuple[int, int]]) -> None:
    """Sum text upward, but for what stands apart."""
    for e, (n, k) in zip(elements, own, strict=True):
        e.own, e.links = n, k
    for e in reversed(elements[1:]):
        if not e.apart:
            e.parent.own += e.own
            e.parent.links += e.links


def _below(elements: list[Element], tops: set[int]) -> set[int]:
    """Ids of the elements ``tops`` and of all below them."""
    inside = set(tops)
    for e in elements[1:]:
        if id(e.parent) in inside:
            inside.add(id(e))
    return inside


def _settle(elements: list[Element], blocks: list, repeated: frozenset[int] = frozenset()) -> None:
    """Sum text upward, and settle what stands apart.

    Tags and hiding attributes decide at once; a page header is apart but for headings
    of an article's own header. Words of class and id are evidence. Words that plainly
    name an advert, comments or the like set an element apart unless it holds an
    article or half of the page's text (comments: all of it). Other words do so only
    together with something else: the element is mostly links, or its text, less
    than half of the page's, is ``repeated`` on other pages of the host, or it is a box outside the place that
    holds the article without it. What is in that place and reads like text stays."""
    own = [(e.own, e.links) for e in elements]
    for e in reversed(elements[1:]):
        e.parent.article = e.parent.article or e.article
    within = _below(elements, {id(e) for e in elements if e.tag == "article"})
    for e in elements[1:]:
        if e.tag in ("html", "body", "article", "main"):
            e.apart = False
        elif e.apart and e.tag not in ("nav", "aside", "footer") and e.article:
            e.apart = False
        elif e.tag == "header" and not e.article:
            e.apart = True
        e.apart = e.apart or e.parent.apart
    _sums(elements, own)
    total = elements[0].own
    said = [e for e in elements[1:] if e.plain and not e.apart]
    # An article element may be a single comment, inside an article or below comments.
    talk = {id(e) for e in said if e.comment and id(e) in within and e.tag != "body"}
    for e in said:
        most = total if e.comment else (total + 1) // 2
        holds = e.article or e.tag in ("html", "body", "article", "main")
        e.apart = e.own < most and (not holds or id(e) in talk)
    _spread(elements)
    _sums(elements, own)
    weak = [e for e in elements[1:] if e.weak and not e.apart and not e.article and e.tag not in ("html", "body", "article", "main")]
    if not weak:
        return
    texts = _texts_of(weak, blocks) if repeated else {}
    total, boxes = elements[0].own, []
    for e in weak:
        if 2 * e.links > e.own or (2 * e.own < total and texts.get(id(e)) in repeated):
            e.apart = True
        elif e.tag in CONTAINERS and 2 * e.own < total:
            e.apart = True
            boxes.append(e)
    if boxes:
        _spread(elements)
        _sums(elements, own)
        dense = best_container(elements)
        if dense is not None:
            place = whole_article(elements, blocks, dense)
            home = _below(elements, {id(place if place.tag in ("article", "main") else dense)})
            kept = {id(e) for e in boxes if id(e) in home}
            for e in elements[1:]:
                e.apart = id(e) not in kept and e.apart
            inside = _below(elements, kept)
            for e in elements[1:]:  # what was apart only for standing in a kept box
                if id(e) in inside and id(e) not in kept and e.apart and not _reason(e, repeated, texts, total):
                    e.apart = e.parent.apart
    _spread(elements)
    _sums(elements, own)


def _reason(e: Element, repeated: frozenset[int], texts: dict[int, int], total: int) -> bool:
    """Whether an element stands apart for itself."""
    if e.tag in APART or (e.tag == "header" and not e.article) or (e.plain and not e.article):
        return True
    return e.weak and (2 * e.links > e.own or (2 * e.own < total and texts.get(id(e)) in repeated))


def _spread(elements: list[Element]) -> None:
    for e in elements[1:]:
        e.apart = e.apart or e.parent.apart


def _texts_of(some: list[Element], blocks: list) -> dict[int, int]:
    """Hash of the text of each of some elements."""
    parts: dict[int, list[str]] = {id(e): [] for e in some}
    for e, pieces, _ in blocks:
        line = None
        while e is not None:
            if id(e) in parts:
                line = " ".join("".join(pieces).split()) if line is None else line
                parts[id(e)].append(line)
            e = e.parent
    return {i: xxhash.xxh64_intdigest("\n".join(p)) >> 1 for i, p in parts.items() if any(p)}


def best_container(elements: list[Element], share: float = 0.8) -> Element | None:
    """The smallest container that holds ``share`` of the page's text outside
    links and parts that stand apart."""
    best = {id(e): e.own - e.links for e in elements if not e.apart}
    total = best[id(elements[0])]
    if total <= 0:
        return None
    here = elements[0]
    for e in elements[1:]:
        # Page order: a later hit lies inside, for two cannot each hold over half.
        if e.tag in CONTAINERS and not e.apart and best[id(e)] >= share * total:
            here = e
    return here


def whole_article(elements: list[Element], blocks: list[tuple[Element, list[str], int]], dense: Element, others: frozenset[int] = frozenset()) -> Element:
    """The outermost ancestor of ``dense`` whose further text is still of the
    article, which the densest container need not hold: an enclosing article, or
    a main where there is none; else a container that adds blocks which do not
    stand apart, are not mostly links and are of no other article. The page as a
    whole (body) may add headings, paragraphs and sections only, and nothing
    beside an article. ``others``: ids of elements that are taken in any case."""
    chain = [dense]
    while chain[-1].parent is not None:
        chain.append(chain[-1].parent)
    level = {id(e): i for i, e in enumerate(chain)}  # of the innermost ancestor of dense around an element
    other, boxed, taken = set(), set(), set(others)  # elements in another article, in a box beside dense, in others
    for e in elements[1:]:
        if id(e) in level:
            continue
        level[id(e)] = level[id(e.parent)]
        if id(e.parent) in taken:
            taken.add(id(e))
        if e.tag in ("article", "main") or id(e.parent) in other:
            other.add(id(e))
        if e.tag in CONTAINERS and e.tag != "section" or id(e.parent) in boxed:
            boxed.add(id(e))
    adds, foreign = set(), set()  # levels with text of the article, with other text
    for e, pieces, linked in blocks:
        i = level[id(e)]
        if not i or id(e) in taken or (e.apart and not _own_heading(e, chain[i])):
            continue
        size = len("".join("".join(pieces).split()))
        if not size:
            continue
        page = chain[i].tag in PAGE_TAGS
        ok = 2 * linked <= size and id(e) not in other and not (page and (id(e) in boxed or e.apart))
        (adds if ok else foreign).add(i)
    here, semantic, stopped, further = dense, dense.tag in ("article", "main"), False, False
    for i, a in enumerate(chain[1:], 1):
        further, stopped = further or i in adds, stopped or i in foreign or (a.tag in PAGE_TAGS and semantic)
        if a.tag == "article" or (a.tag == "main" and not semantic):
            here, semantic, stopped, further = a, True, False, False
        elif further and not stopped and (a.tag in CONTAINERS or a.parent is None):
            here, further = a, False
    return here


def container_vote(html: str) -> tuple[str, int, list[str]] | None:
    """(generalised path of the container of the page's article, its score, paths
    of the outermost elements with text beside it)."""
    return page_votes(html)[0]


def page_votes(html: str) -> tuple[tuple[str, int, list[str]] | None, list[int]]:
    """The vote of :func:`container_vote`, and hashes of the texts of
    its elements whose class or id has a word of APART_WORDS."""
    elements, blocks = parse(html)
    weak = sorted(set(_texts_of([e for e in elements if e.weak], blocks).values()))
    return _vote(elements, blocks), weak


def _vote(elements: list[Element], blocks: list) -> tuple[str, int, list[str]] | None:
    _settle(elements, blocks)
    e = best_container(elements)
    if e is None:
        return None
    e = whole_article(elements, blocks, e)
    around, top = {id(e)}, {}  # ancestors of e; of each other element, the outermost one below these
    p = e.parent
    while p is not None:
        around.add(id(p))
        p = p.parent
    for x in elements[1:]:
        if id(x) not in around:
            top[id(x)] = (None if x.parent is e else x) if id(x.parent) in around else top[id(x.parent)]
    tops = (top.get(id(x)) for x, pieces, _ in blocks if not x.apart and "".join(pieces).strip())
    return e.path, e.own - e.links, sorted({t.path for t in tops if t is not None and t.tag in BLOCK} - {e.path})


def _set_apart(elements: list[Element], paths: frozenset[str], places: list[Element]) -> None:
    """Set apart the elements at ``paths`` that neither hold a place nor lie in one."""
    inside, holds, gone = {id(e) for e in places}, set(), set()
    for e in places:
        while e.parent is not None and id(e.parent) not in holds:
            e = e.parent
            holds.add(id(e))
    for e in elements[1:]:
        if id(e.parent) in inside:
            inside.add(id(e))
        elif id(e.parent) in gone:
            gone.add(id(e))
            e.apart = True
        elif e.path in paths and e.tag in BLOCK and not e.apart and id(e) not in inside and id(e) not in holds:
            gone.add(id(e))
            e.apart = True
            p = e.parent
            while p is not None:
                p.own, p.links, p = p.own - e.own, p.links - e.links, p.parent


def article_text(html: str, path: str | None, beside: Iterable[str] = (), repeated: Iterable[int] = ()) -> str:
    """Text of all containers at ``path``; of the page's own best one if it has
    none there (or nothing in it), or less than half of the best one's text.
    ``beside``: paths of what stands beside the article on pages of this kind;
    ``repeated``: hashes of texts that the host's pages share."""
    elements, blocks = parse(html)
    _settle(elements, blocks, frozenset(repeated))
    places = []
    if path is not None:
        places = [e for e in elements if e.path == path and (e.tag in CONTAINERS or e.parent is None) and not e.apart and e.own > e.links]
        if places:
            _set_apart(elements, frozenset(beside), places)
    own = best_container(elements)
    own = own and whole_article(elements, blocks, own)
    if own is not None and 2 * sum(e.own - e.links for e in places) < own.own - own.links:
        places = [own]
    if not places:
        return ""
    dense = max(places, key=lambda e: e.own - e.links)
    place = whole_article(elements, blocks, dense, frozenset(id(e) for e in places if e is not dense))
    inside = {id(place)} | {id(e) for e in places}
    for e in elements:
        if e.parent is not None and id(e.parent) in inside:
            inside.add(id(e))
    out = []
    for e, pieces, _ in blocks:
        if id(e) in inside and (not e.apart or any(_own_heading(e, p) for p in (place, *places))):
            line = " ".join("".join(pieces).split())
            if line:
                out.append(line)
    return "\n".join(out)


def _own_heading(e: Element, place: Element) -> bool:
    """Whether a block is a heading in the article's own header."""
    heading = False
    while e is not place and e is not None:
        heading = heading or e.tag in HEADINGS
        if e.tag == "header":
            return heading and not (e.parent.apart)
        if e.apart and e.tag not in HEADINGS and e.tag not in ("div", "span", "b", "strong", "em", "i", "a"):
            return False
        e = e.parent
    return False
