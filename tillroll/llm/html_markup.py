"""The text blocks of a web page, and which of them its markup excludes.

A page is read tag by tag with a stack of open elements (missing end tags of paragraphs, items and
cells are implied). Text is excluded inside elements that hold no article text by their tag
(menus, page headers and footers, side bars, forms, ...), by a role, by a *whole* class or id token that
names such a part (``sidebar``, ``site-footer``, ``ad_slot`` but not ``has-sidebar``), or
hidden by an attribute. Raw text (scripts, styles, titles) is never text. Rules of caution:

* an element excluded by its name, or a form, is kept after all if it holds an ``article`` or ``main``;
* a form without an end tag excludes nothing, and an inline element without one only the block
  that it begins in;
* if nothing would be left of a page, names and forms exclude nothing (comments and adverts still go).

If the page has an article or main element, only text inside one counts; an article among readers'
comments, in a menu, a footer or an aside is none.
"""

from __future__ import annotations

import html
import re

#: Element names of HTML by what they mean here.
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav footer aside form button dialog menu select datalist noscript template svg math object "
                    "canvas audio video".split())
NO_ARTICLE = frozenset("nav footer aside menu dialog noscript template select datalist".split())
MAIN = frozenset("article main".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
#: An opening tag ends an open element of these names, up to the nearest of the others.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}),
}
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
#: Class and id tokens that name a part: an optional place, the part, and parts of a compound name.
_PLACE = r"(?:(?:site|page|global|top|bottom|left|right|primary|secondary|sticky|main)[-_])?"
_MORE = (r"(?:[-_]?(?:container|wrapper|wrap|box|area|list|section|block|bar|inner|left|right|slot|unit|widget|"
         r"links?|menu|banner|form|top|bottom|items?|title|body|\d+))*")
PART = re.compile(
    rf"{_PLACE}(?:ads?|adverts?|advertisements?|adsense|adbox|banner|sponsor(?:ed)?|promo|nav|navbar|"
    rf"navigation|menu|breadcrumbs?|sidebar|footer|masthead|topbar|cookies?|consent|gdpr|notices?|alerts?|popup|"
    rf"modal|newsletter|subscribe|signup|login|share|sharing|social|toolbar|pagination|pager|skip[-_]?link"
    rf"){_MORE}|site[-_]header|skip|related(?:[-_](?:posts|articles|links|stories))?")
COMMENT = re.compile(
    r"(?:user[-_]?|reader[-_]?)?(?:comments?|repl(?:y|ies)|leave[-_]?(?:reply|comment)|respond|disqus|disqus_thread)"
    r"(?:[-_]?(?:list|area|respond|form|reply|link|section|wrap|wrapper|thread|body|content|text|box|"
    r"container|title|item|author|meta|children|\d+))*")
ADVERT = re.compile(rf"{_PLACE}(?:ads?|adverts?|advertisements?|adsense|adbox|sponsor(?:ed)?){_MORE}")

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
                  re.S)
_TELLS = re.compile(r"class|id|role|hidden|style", re.I)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
TAG, NAME, CERTAIN = range(3)  # why an element is excluded; a comment, advert or hidden one certainly


class Excluded:
    """An open element whose text may not count."""

    __slots__ = ("why", "tag", "inline", "first", "closed", "holds_main", "comment")

    def __init__(self, why: int, tag: str, first: int, comment: bool = False):
        self.why, self.tag, self.inline, self.first, self.comment = why, tag, tag not in BLOCKS, first, comment
        self.closed = self.holds_main = False

    def excludes(self, block: int, bare: bool) -> bool:
        if self.why == CERTAIN:
            return not self.inline or self.closed or block == self.first
        if self.why == NAME or self.tag == "form":
            if bare or self.holds_main or self.tag == "form" and not self.closed:
                return False
            return not self.inline or self.closed or block == self.first
        return not self.holds_main


def attributes_of(text: str) -> dict[str, str]:
    return {n.lower(): a or b or c for n, a, b, c in _ATTRIBUTE.findall(text)}


def reason(tag: str, text: str, in_main: bool) -> tuple[int, bool] | None:
    """Why an opening tag excludes its element, and whether it holds comments."""
    found = attributes_of(text) if text and _TELLS.search(text) else {}
    tokens = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    if any(COMMENT.fullmatch(t) for t in tokens):
        return CERTAIN, True
    hidden = "hidden" in found and found["hidden"].lower() != "until-found" \
        or found.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(found.get("style", ""))
    if hidden and tag not in ("html", "body"):
        return CERTAIN, False
    if tag in MAIN or tag in ("html", "body"):
        return None
    if any(ADVERT.fullmatch(t) for t in tokens):
        return CERTAIN, False
    if tag in OUTSIDE or tag == "header" and not in_main:
        return TAG, False
    if any(PART.fullmatch(t) for t in tokens) or ROLES.intersection(found.get("role", "").lower().split()):
        return NAME, False
    return None


class Page:
    """The blocks of a page: (segments, in main), each segment its excluding elements and text."""

    def __init__(self, page: str):
        self.blocks: list[tuple[list, bool]] = []
        self.segments: list[tuple[tuple, str]] = []
        self.stack: list[tuple[str, Excluded | None, bool]] = []
        self.open: tuple[Excluded, ...] = ()  # of the stack
        self.in_main = 0
        self._read(page)
        self.flush()

    def flush(self) -> None:
        if self.segments:
            if any(not t.isspace() for _, t in self.segments):
                self.blocks.append((self.segments, self.in_main > 0))
            self.segments = []

    def text(self, text: str) -> None:
        if text:
            self.segments.append((self.open, text))

    def _read(self, page: str) -> None:
        at, end = 0, len(page)
        while at < end:
            m = _TAG.search(page, at)
            if m is None:
                self.text(page[at:])
                return
            self.text(page[at:m.start()])
            at = m.end()
            tag = (m.group(2) or "").lower()
            if not tag:
                continue
            if m.group(1):
                self.close(tag)
            elif tag in RAW:
                over = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
                if over:
                    at = over.end()
                elif tag in ("script", "style"):
                    return
            else:
                self.start(tag, m.group(3))

    def start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.text(" ")
            elif tag == "hr":
                self.flush()
            return
        if tag == "svg" and attributes.endswith("/"):
            return
        if tag in BLOCKS:
            self.flush()
            ends, limits = IMPLIED.get(tag, (None, None))
            if ends:
                self._imply(ends, limits)
            self._imply({"p"}, BLOCKS - {"p"})
        why = reason(tag, attributes, self.in_main > 0)
        excluded = why and Excluded(why[0], tag, len(self.blocks), why[1])
        is_main = tag in MAIN and not excluded and not any(
            x.comment or x.why == CERTAIN or x.tag in NO_ARTICLE for x in self.open)
        if is_main:
            for x in self.open:
                x.holds_main = True
        self.stack.append((tag, excluded, is_main))
        if excluded:
            self.open += (excluded,)
        self.in_main += is_main

    def _imply(self, ends: set[str], limits) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag in ends:
                self._cut(i)
                return
            if tag in limits:
                return

    def close(self, tag: str) -> None:
        inline = tag not in BLOCKS
        if not inline:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            other, excluded, _ = self.stack[i]
            if other == tag:
                if excluded:
                    excluded.closed = True
                self._cut(i)
                return
            if inline and other in BLOCKS and tag not in OUTSIDE:
                return

    def _cut(self, size: int) -> None:
        for _, excluded, is_main in self.stack[size:]:
            self.in_main -= is_main
        del self.stack[size:]
        self.open = tuple(x for _, x, _ in self.stack if x)

    def texts(self, bare: bool = False) -> list[tuple[str, bool]]:
        """(text, in main) of each block with text that isn't excluded."""
        out = []
        for i, (segments, in_main) in enumerate(self.blocks):
            kept = [t for xs, t in segments if not xs or not any(x.excludes(i, bare) for x in xs)]
            text = plain(kept) if kept else ""
            if text:
                out.append((text, in_main))
        return out


def plain(parts: list[str]) -> str:
    return " ".join(html.unescape("".join(parts)).split())


def blocks_of(page: str) -> tuple[list[str], bool, list[str]]:
    """The kept blocks, whether they come from an article or main element, and the blocks to hold
    against other pages of the host: all that stand beside that element, excluded or not; the kept
    ones of a page without it."""
    read = Page(page)
    kept = read.texts() or read.texts(bare=True)
    main = [t for t, inside in kept if inside]
    if not main:
        texts = [t for t, _ in kept]
        return texts, False, texts
    beside = [plain([t for _, t in segments]) for segments, inside in read.blocks if not inside]
    return main, True, [t for t in beside if t]
