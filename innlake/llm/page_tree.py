"""A small tolerant HTML reader: elements, their fingerprints, and text blocks."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import xxhash

# Fixed values of the HTML standard: what elements are, and what opens or closes what.
RAW = "script style noscript template iframe svg math object textarea title noembed noframes xmp".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
 figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
 search section summary table tbody tfoot thead tr ul""".split())
CLOSES_P = BLOCK - set("body caption dd dt head html legend li optgroup option summary tbody tfoot thead tr".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
        "tfoot": {"tr", "td", "th", "tbody"}}
FENCE = set("ul ol dl table select article section main aside nav header footer div body html form blockquote".split())

# What isn't main text, by element, role, or a word of a class or id.
ASIDE_TAGS = set("nav footer aside form button select input dialog menu head search".split()) | set(RAW)
ASIDE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
ASIDE_WORDS = set("""ad ads adbox advert advertisement advertising adsense banner breadcrumb breadcrumbs comment
 comments commentlist consent cookie cookies disclaimer disqus footer gdpr header login masthead menu modal nav navbar
 navigation newsletter notice notification overlay pager pagination popup promo promotion recommended related replies
 respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget""".split())
READERS = {"comment", "comments", "commentlist", "replies", "respond", "disqus"}
# Aside when search for marked articles fails elsewhere, too.
CLOSED_TAGS = set("nav footer aside head".split()) | set(RAW)
# Words that may stand beside an aside word in a hyphenated class: "site-header" is a header, "no-sidebar" no sidebar.
PLACES = set("""area bar block bottom box button buttons inner item items left link links list main page primary right
 secondary section site text top""".split())
# Prose: lines of text, lists and tables may be the same in several articles; without a label they aren't template.
LINES = set("p blockquote pre hr summary li dt dd tr td th thead tbody tfoot caption option optgroup legend h1 h2 h3 h4 h5 h6".split())
PROSE = LINES | set("ul ol dl table".split())
#: Share of the words left that marked articles must hold to be the page's main text.
MARKED_SHARE = 0.25

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*>"
    r"|<[!?/][^>]*>", re.S | re.I)
_ATTR = re.compile(r"(class|id|role|aria-hidden|itemprop|style|hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[a-z0-9]+")


def _names(tokens: str) -> set[str]:
    """Aside words that the tokens of a class or id are, whole or beside words for places."""
    found = set()
    for token in tokens.split():
        parts = set(_WORD.findall(token))
        if parts <= ASIDE_WORDS | PLACES:
            found |= parts & ASIDE_WORDS
    return found
_INSIDE = 0x5851F42D4C957F2D


@dataclass(slots=True)
class Element:
    tag: str
    label: str = ""
    main: bool = False
    aside: bool = False
    closed: bool = False
    words: bool = False
    parts: list = field(default_factory=list)
    print: int = 0


def _describe(element: Element, attrs: str) -> None:
    values = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTR.findall(attrs)} if attrs.strip(" /") else {}
    element.label = f"{values.get('class', '')}|{values.get('id', '')}|{values.get('role', '')}"
    words = _names(values.get("class", "") + " " + values.get("id", "")) if values else set()
    tag = element.tag
    element.main = tag in ("article", "main") or values.get("role") == "main" or values.get("itemprop") == "articlebody"
    hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "")
    if tag in ("html", "body", "main"):
        element.aside = False
    elif tag == "article":
        element.aside = bool(words & READERS) or hidden
    else:
        element.aside = tag in ASIDE_TAGS or values.get("role") in ASIDE_ROLES or bool(words) or hidden
    element.closed = element.aside and (hidden or tag in CLOSED_TAGS or bool(words & READERS))
    if element.aside:
        element.main = False


def parse(source: str) -> Element:
    """The root of the page's elements; fingerprints cover tag, class, id, role, text and children."""
    root = Element("")
    stack = [root]

    def close(n: int) -> None:
        while len(stack) > n:
            done = stack.pop()
            done.words = any(p.words if isinstance(p, Element) else not p.isspace() for p in done.parts)
            done.print = _fingerprint(done)

    def add_text(text: str) -> None:
        if text:
            stack[-1].parts.append(html.unescape(text) if "&" in text else text)

    at = 0
    for m in _TOKEN.finditer(source):
        add_text(source[at: m.start()])
        at = m.end()
        name = m["tag"] or m["tag2"]
        if not name:
            continue
        tag = name.lower()
        if m["end"] or m["end2"]:
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if place:
                close(place)
            elif tag == "br":
                stack[-1].parts.append(" ")
            continue
        if tag == "br":
            stack[-1].parts.append(" ")
            continue
        ends = SAME.get(tag, frozenset()) | ({"p"} if tag in CLOSES_P else frozenset())
        if ends:
            place = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    place = i
                elif stack[i].tag in FENCE:
                    break
            if place:
                close(place)
        element = Element(tag)
        _describe(element, m["attrs"] or "")
        stack[-1].parts.append(element)
        stack.append(element)
        if tag in VOID or (m["attrs"] or "").endswith("/") and tag not in BLOCK:
            close(len(stack) - 1)
    add_text(source[at:])
    close(0)
    return root


def _fingerprint(element: Element) -> int:
    own = [element.tag, element.label]
    for part in element.parts:
        own.append(str(part.print) if isinstance(part, Element) else " ".join(part.split()))
    return _hash("\x1f".join(own))


def _mains(root: Element) -> list[Element]:
    """The outermost article or main elements; those under aside wrappers count if there are no others."""
    for deep in (False, True):
        found, todo = [], [root]
        while todo:
            element = todo.pop()
            if element.main:
                found.append(element)
            elif not (element.closed if deep else element.aside):
                todo += [p for p in reversed(element.parts) if isinstance(p, Element)]
        if found:
            return found
    return []


def _hash(text: str) -> int:
    # Signed, as Spark's numbers are.
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def prints(root: Element) -> set[tuple[int, int, bool]]:
    """(fingerprint, vote, whether in an article) of the page's elements that may be templates.

    The vote names the text that the element stands in, without what is aside: that of its article, or of the page.
    Copies of a page or article vote alike. Words inside a line of text are no template.
    """
    mains = _mains(root)
    marked = set(map(id, mains))
    found = set()
    page = _hash(_blocks(mains or [root], bool(mains), set()))
    for top, vote in [(root, page), *((m, _hash(_blocks([m], True, set()))) for m in mains)]:
        todo = [top]
        while todo:
            element = todo.pop()
            alone = _alone(element)
            for part in element.parts:
                if not isinstance(part, Element) or not part.words or id(part) in marked:
                    continue
                if _deletable(part, alone, top is not root) and part.tag not in ("html", "body"):
                    found.add((_named(part, top is not root), vote, top is not root))
                todo.append(part)
    return found


def _named(part: Element, inside: bool) -> int:
    """Fingerprints inside articles have names of their own, as they are counted by themselves."""
    return part.print ^ _INSIDE if inside else part.print


def _alone(parent: Element) -> bool:
    """Its elements stand by themselves: no text beside them, and the parent is no line of prose."""
    return parent.tag not in LINES and not any(isinstance(p, str) and not p.isspace() for p in parent.parts)


def _deletable(part: Element, alone: bool, inside: bool) -> bool:
    """Inside articles labelled containers (by class, id or role); elsewhere what isn't an unlabelled line of prose."""
    labelled = part.label.strip("| ") != ""
    if inside:
        return labelled and part.tag in BLOCK and part.tag not in PROSE
    return (alone or part.tag in BLOCK) and (labelled or part.tag not in LINES)


def text(root: Element, templates: set[int]) -> str:
    """Main text: what is left without templates and what is aside.

    Where articles are marked and hold MARKED_SHARE of the words left, theirs alone.
    """
    mains = _mains(root)
    if mains:
        inside = _blocks(mains, True, templates)
        outside = _blocks([root], False, templates, set(map(id, mains)))
        mine, others = inside.count(" ") + inside.count("\n"), outside.count(" ") + outside.count("\n")
        if not outside or mine >= MARKED_SHARE * (mine + others):
            return inside
    return _blocks([root], False, templates)


def _blocks(tops: list[Element], inside: bool, templates: set[int], without: set[int] = frozenset()) -> str:
    """Text of the elements tops, one line a block; `without` names elements (by id()) that are left out."""
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        own = " ".join("".join(line).split())
        if own:
            blocks.append(own)
        line.clear()

    for top in tops:
        # Of each part: whether it ends here, and whether its parent has no text beside its elements.
        walk: list[tuple[object, bool, bool]] = [(top, False, True)]
        while walk:
            part, closing, alone = walk.pop()
            if isinstance(part, str):
                line.append(part)
                continue
            block = part.tag in BLOCK
            if closing:
                if block:
                    flush()
                elif part.tag in ("td", "th"):
                    line.append(" ")
                continue
            if part is not top and (part.aside or id(part) in without or part.tag == "header" and not inside
                                    or templates and _named(part, inside) in templates
                                    and _deletable(part, alone, inside)):
                if block:
                    flush()
                continue
            if block:
                flush()
            walk.append((part, True, alone))
            own = bool(templates) and _alone(part)
            walk += [(p, False, own) for p in reversed(part.parts)]
        flush()
    return "\n".join(blocks)
