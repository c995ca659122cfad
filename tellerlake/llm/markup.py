"""One HTML page as elements and text in document order, and the text of its article."""

import html
import re
from array import array

import xxhash

_NAME = r"[a-zA-Z][^\s/>]*+"
_OPEN = re.compile(rf"<({_NAME})((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>")
_OPEN_PLAIN = re.compile(rf"<({_NAME})([^>]*+)>")
_CLOSE = re.compile(rf"</({_NAME})[^>]*+>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

# Element names of the HTML standard (fixed values).
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noframes", "xmp"))
INLINE = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var",
))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"))
PROSE = HEADINGS | {"p", "pre", "blockquote", "li", "dd", "dt", "td", "th", "tr", "figcaption", "caption"}
#: Cells of a row share its block; a row, not its cells, begins a new one.
UNBROKEN = frozenset(("td", "th"))
IN_HEAD = frozenset(("base", "link", "meta", "title", "style", "script", "noscript", "template"))
#: Opening one of these ends an open paragraph of the same container.
ENDS_PARAGRAPH = HEADINGS | {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "dd", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "header", "hr", "li", "main", "menu", "nav", "ol", "p",
    "pre", "search", "section", "summary", "table", "ul",
}
#: For each of these, what it ends when it opens, and how far out to look for that.
ENDS_SIBLING = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}
SCOPE = frozenset(("html", "table", "td", "th", "caption", "object", "template"))

# What is not the article (fixed values): by element, by role, by words of class and id.
APART = frozenset((
    "head", "nav", "footer", "aside", "menu", "dialog", "script", "style", "noscript", "template", "iframe",
    "noframes", "object", "svg", "math", "canvas", "audio", "video", "button", "select", "textarea", "title", "xmp",
))
APART_ROLES = frozenset((
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu",
    "menubar", "toolbar", "status",
))
APART_WORDS = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
    "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal",
    "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "nav", "navbar", "navigation", "menu",
    "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "topbar", "sidebar", "sidebars", "widget", "widgets",
    "footer", "header", "masthead", "comment", "comments", "disqus", "replies", "respond", "share", "sharing", "social",
    "related", "recommended", "recommendations", "teaser", "teasers", "search", "skip", "hidden",
))
#: Where the article is, surest first: by element or role, else by a word of class or id.
MAIN_WORDS = frozenset(("article", "content", "post", "entry", "story", "main"))

#: How sure it is that a subtree is of the site: it recurs on many pages, or on most of them.
PLAIN, STRICT = 1, 2


class Page:
    """The elements of a page, numbered in document order, and its text in pieces that name their element.

    Broken markup is read as browsers do in the main: paragraphs, list items and cells end where the next begins,
    end tags without a start are passed over, open elements end with the page. Nothing recurses, so nesting may be
    as deep as it likes. An element's digest covers its name, its text and its children's digests, not attributes.
    """

    def __init__(self, text: str):
        self.tags: list[str] = []
        self.attributes: list[str] = []
        self.parents = array("q")
        self.digests = array("Q")
        self.sizes = array("q")  # of the text, without white space
        self.pieces: list[tuple[int, str | None]] = []  # None: a block begins or ends
        self.longest, self.longest_text = 0, ""
        self._found: list[int] | None = None
        self._stack: list[int] = []
        self._hashes: list = []
        self._block: list[str] = []
        self._start("#root", "")
        self._read(text)
        while self._stack:
            self._end()

    def _start(self, tag: str, attributes: str) -> None:
        number = len(self.tags)
        self.tags.append(tag)
        self.attributes.append(attributes)
        self.parents.append(self._stack[-1] if self._stack else -1)
        self.digests.append(0)
        self.sizes.append(0)
        if tag not in INLINE and tag not in UNBROKEN:
            self._break(number)
        self._stack.append(number)
        self._hashes.append(xxhash.xxh64(tag + " "))

    def _end(self) -> None:
        number = self._stack.pop()
        self.digests[number] = digest = self._hashes.pop().intdigest()
        if self._stack:
            self.sizes[self._stack[-1]] += self.sizes[number]
            self._hashes[-1].update(digest.to_bytes(8, "little"))
        if self.tags[number] not in INLINE and self.tags[number] not in UNBROKEN:
            self._break(number)

    def _break(self, number: int) -> None:
        self.pieces.append((number, None))
        text = " ".join(self._block)
        self._block.clear()
        if len(text) > self.longest:
            self.longest, self.longest_text = len(text), text

    def _text(self, text: str, visible: bool = True) -> None:
        if "&" in text:
            text = html.unescape(text)
        words = " ".join(text.split())
        top = self._stack[-1]
        if words:
            if self.tags[top] == "head":
                self._end()
                top = self._stack[-1]
            self._hashes[-1].update(words)
            if visible:
                self.sizes[top] += len(words) - words.count(" ")
                self._block.append(words)
        if visible:
            self.pieces.append((top, text))

    def _read(self, text: str) -> None:
        at, size, quoted = 0, len(text), True
        while at < size:
            tag = text.find("<", at)
            if tag < 0:
                self._text(text[at:])
                return
            if tag > at:
                self._text(text[at:tag])
            following = text[tag + 1 : tag + 2]
            if following.isascii() and following.isalpha():
                found = _OPEN.match(text, tag) if quoted else None
                if found is None:
                    quoted = False  # a quote that never ends: read plainly from here on
                    found = _OPEN_PLAIN.match(text, tag)
                if found is None:
                    return  # a tag that never ends takes the rest with it
                at = self._opened(text, found)
            elif following == "/":
                found = _CLOSE.match(text, tag)
                if found:
                    self._closed(found.group(1).lower())
                    at = found.end()
                else:
                    at = text.find(">", tag) + 1 or size
            elif following == "!" or following == "?":
                if text.startswith("<!--", tag):
                    short = text.startswith(("<!-->", "<!--->"), tag)
                    at = (text.find(">", tag) + 1) if short else (text.find("-->", tag + 4) + 3)
                    at = size if at < tag + 3 else at
                else:
                    at = text.find(">", tag) + 1 or size
            else:
                self._text("<")
                at = tag + 1

    def _opened(self, text: str, found: re.Match) -> int:
        tag, attributes, at = found.group(1).lower(), found.group(2), found.end()
        top = self.tags[self._stack[-1]]
        if top == "head" and tag not in IN_HEAD and tag != "head":
            self._end()
        if tag in ("html", "body") and tag in self.tags:
            return at
        if tag == "br":
            self.pieces.append((self._stack[-1], " "))
            return at
        if tag in ENDS_PARAGRAPH:
            self._end_open(("p",), SCOPE, through_blocks=False)
        if tag in ENDS_SIBLING:
            self._end_open(*ENDS_SIBLING[tag])
        if tag in VOID:
            if tag == "hr":
                self._break(self._stack[-1])
            return at
        if tag in RAW:
            self._start(tag, attributes)
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(text, at)
            self._text(text[at : end.start()] if end else text[at:], visible=False)
            self._end()
            return text.find(">", end.end()) + 1 or len(text) if end else len(text)
        if tag not in INLINE or "=" in attributes or "hidden" in attributes:
            if not (attributes.endswith("/") and tag in ("svg", "path")):
                self._start(tag, attributes)
        return at

    def _end_open(self, tags, limits, through_blocks: bool = True) -> None:
        """End the nearest open element of those names, if no limit comes first."""
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[depth]]
            if tag in tags:
                while len(self._stack) > depth:
                    self._end()
                return
            if tag in limits or (not through_blocks and tag not in INLINE):
                return

    def _closed(self, tag: str) -> None:
        if tag in INLINE:
            self._end_open((tag,), (), through_blocks=False)
        elif tag not in ("html", "body"):
            self._end_open((tag,), ("#root",) if tag in SCOPE else SCOPE)

    def identity(self) -> int:
        """The digest of the longest block: copies of a page share it, whatever surrounds them."""
        return signed(xxhash.xxh64_intdigest(self.longest_text))

    def subtrees(self) -> tuple[set[int], set[int], set[int]]:
        """Digests, as signed numbers, of the elements with text, by what makes them go from this page.

        Those beside the article are only counted: it is chosen without them. Inside a marked article, and
        for a piece of prose anywhere, the finding has to be STRICT, for articles share passages; of other
        elements a PLAIN one is enough.
        """
        beside, strict, plain = set(), set(), set()
        needs = self._needs()
        for number, tag in enumerate(self.tags):
            if self.sizes[number] and tag not in INLINE and tag not in RAW and tag not in ("#root", "html", "head", "body"):
                (beside, plain, strict)[needs[number]].add(signed(self.digests[number]))
        strict -= plain
        return beside - plain - strict, strict, plain

    def article(self, templates: dict[int, int]) -> str:
        """The article's text, without the elements that ``templates`` (digest: PLAIN or STRICT) says are of the site."""
        needs = self._needs()
        count = len(self.tags)
        out = [False] * count
        heading = [False] * count
        for number in range(count):
            parent = self.parents[number]
            found = templates.get(signed(self.digests[number]), 0) if templates else 0
            out[number] = (parent >= 0 and out[parent]) or bool(needs[number]) and found >= needs[number]
            heading[number] = self.tags[number] in HEADINGS or (parent >= 0 and heading[parent])
        blocks, block = [], []
        for number, text in self.pieces:
            if text is None:
                if block:
                    blocks.append(block)
                    block = []
            elif self._within[number] and not out[number] and (heading[number] or not self._in_header[number]):
                block.append(text)
        blocks.append(block)
        joined = (" ".join("".join(block).split()) for block in blocks)
        return "\n\n".join(text for text in joined if text)

    def _needs(self) -> list[int]:
        """Of each element: the finding that makes it go, 0 for what is not in the article or holds it.

        First goes what element, role, class and id say is no article: menus and the like. An element around the
        article never does. Then the article is chosen from what is left.
        """
        if self._found is not None:
            return self._found
        count = len(self.tags)
        words = [self._words(number) for number in range(count)]
        main = [self._is_main(number, words[number]) for number in range(count)]
        inside = [False] * count  # of an article or main element
        holds = [False] * count
        for number in range(1, count):
            parent = self.parents[number]
            inside[number] = inside[parent] or main[parent]
        for number in range(count - 1, 0, -1):
            if holds[number] or main[number]:
                holds[self.parents[number]] = True
        gone = [False] * count
        self._in_header = [False] * count
        for number in range(1, count):
            parent = self.parents[number]
            self._in_header[number] = self._in_header[parent]
            if gone[parent] or self.tags[number] in APART:
                gone[number] = True
            elif self._apart(number, words[number], main[number], holds, inside):
                # Of an article's own header the headings stay.
                if inside[number] and self._is_header(number, words[number]):
                    self._in_header[number] = True
                else:
                    gone[number] = True
        marked, chosen = self._containers(words, main, gone)
        self._within = [False] * count
        self._found = [0] * count
        for number in range(count):
            parent = self.parents[number]
            below = parent >= 0 and self._within[parent]
            self._within[number] = not gone[number] and (below or number in chosen)
            if below and not gone[number] and number not in chosen:
                self._found[number] = STRICT if marked or self.tags[number] in PROSE else PLAIN
        return self._found

    def _words(self, number: int) -> tuple[frozenset[str], str, bool]:
        """Words of class and id, the role, and whether the element is hidden."""
        text = self.attributes[number]
        if "=" not in text and "hidden" not in text:
            return frozenset(), "", False
        names, role, hidden = [], "", False
        for name, double, single, bare in _ATTRIBUTE.findall(text):
            name, value = name.lower(), html.unescape(double or single or bare)
            if name in ("class", "id"):
                for token in value.split():
                    found = _WORD.findall(token)
                    # "comments-open" on an article is about it; only "comment" says that it is one.
                    if len(found) == 1 or self.tags[number] not in ("article", "main"):
                        names += found
            elif name == "role":
                role = value.strip().lower()
            elif name == "itemprop" and value == "articleBody":
                role = "main"
            elif name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
                hidden = True
        return frozenset(n.lower() for n in names), role, hidden

    def _is_main(self, number: int, words) -> bool:
        names, role, _ = words
        return (self.tags[number] in ("article", "main") or role == "main") and not names & APART_WORDS

    def _is_header(self, number: int, words) -> bool:
        return self.tags[number] == "header" or "header" in words[0]

    def _apart(self, number: int, words, main: bool, holds, inside) -> bool:
        names, role, hidden = words
        tag = self.tags[number]
        if holds[number] or main or tag in ("html", "body"):
            return False
        named = hidden or role in APART_ROLES or tag in ("header", "form") or bool(names & APART_WORDS)
        # A form or a "with-sidebar" wrapper may go around a whole page that marks no article.
        return named and (inside[number] or holds[0] or self.sizes[number] * 2 <= self.sizes[0])

    def _containers(self, words, main, gone) -> tuple[bool, set[int]]:
        """Whether the page marks its article, and the elements that hold it: the largest and its like beside it."""
        live = [number for number in range(1, len(self.tags)) if not gone[number] and self.sizes[number]]
        kinds = (
            (True, lambda n: self.tags[n] == "article"),
            (True, lambda n: main[n]),
            (False, lambda n: self.tags[n] not in INLINE and self.tags[n] not in ("html", "body")
             and bool(words[n][0] & MAIN_WORDS) and self.sizes[n] * 2 > self.sizes[0]),
        )
        for marked, kind in kinds:
            found = [n for n in live if kind(n)]
            if found:
                largest = max(found, key=lambda n: (self.sizes[n], -n))
                return marked, {n for n in found if self.parents[n] == self.parents[largest]}
        return False, {0}


def signed(number: int) -> int:
    return number - (1 << 64) * (number >> 63)
