"""A page as a tree of block elements, whose leaves are runs of inline text."""

from __future__ import annotations

from html.parser import HTMLParser

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HIDDEN = frozenset("script style noscript template head title svg math iframe object canvas audio video select option button textarea datalist".split())
#: What may stand in a head; anything else ends it.
IN_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An element that begins ends these, if they are open above it and below the nearest of the second group.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
}


class Node:
    __slots__ = ("above", "linked", "tag", "text", "words")

    def __init__(self, tag: str, above: int, words: str = "", text: str = "", linked: int = 0):
        self.tag, self.above, self.words, self.text, self.linked = tag, above, words, text, linked


class Page(HTMLParser):
    """``nodes`` in page order, each after its parent (``above``, -1 for the root).  A leaf has the tag ``#text``."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("html", -1)]
        self.open = [0]
        self.run: list[str] = []
        self.hidden: list[str] = []
        self.linked = self.links = 0
        self.feed(html)
        self.close()
        self._leaf()

    def _leaf(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            self.nodes.append(Node("#text", self.open[-1], text=text, linked=self.linked))
        self.run, self.linked = [], 0

    def _shut(self, depth: int) -> None:
        self._leaf()
        del self.open[depth:]
        self.links = 0

    def _depth(self, tags: set, until: set) -> int | None:
        """The highest open element of ``tags`` above any of ``until``, from the inside."""
        found = None
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.nodes[self.open[depth]].tag
            if tag in until:
                break
            if tag in tags:
                found = depth
        return found

    def _reveal(self, ends: bool, tag: str) -> None:
        """End the innermost hidden element if it is a ``tag`` whose end tag was left out."""
        if ends and self.hidden and self.hidden[-1] == tag:
            self.hidden.pop()

    def handle_starttag(self, tag, attrs):
        self._reveal(tag not in IN_HEAD, "head")
        self._reveal(tag in ("option", "optgroup"), "option")
        if self.hidden or tag in HIDDEN:
            if tag in HIDDEN:
                self.hidden.append(tag)
        elif tag == "br":
            self.run.append(" ")
        elif tag == "hr":
            self._leaf()
        elif tag == "a":
            self.links += 1
        elif tag in BLOCKS:
            self._leaf()
            tags, until = ENDS.get(tag, (set(), set()))
            depth = self._depth(tags | {"p"}, until | {"button", "td", "th", "blockquote", "article", "section"})
            if depth is not None:
                self._shut(depth)
            if tag not in VOID and tag not in ("html", "body"):
                words = " ".join(str(v) for k, v in attrs if v and k in ("class", "id", "role")).lower()
                self.nodes.append(Node(tag, self.open[-1], words))
                self.open.append(len(self.nodes) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in HIDDEN or tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._reveal(tag in ("body", "html"), "head")
        if set(self.hidden) == {"option"} and tag in {self.nodes[i].tag for i in self.open}:
            self.hidden.clear()  # the element around options without a select ends
        if self.hidden:
            if tag in self.hidden:
                while self.hidden.pop() != tag:
                    pass
        elif tag == "a":
            self.links = max(0, self.links - 1)
        elif tag in BLOCKS and tag not in ("html", "body"):
            for depth in range(len(self.open) - 1, 0, -1):
                if self.nodes[self.open[depth]].tag == tag:
                    self._shut(depth)
                    break
            else:
                self._leaf()

    def handle_data(self, data):
        self._reveal(bool(data.strip()), "head")
        if not self.hidden:
            self.run.append(data)
            if self.links:
                self.linked += len(data.strip())
