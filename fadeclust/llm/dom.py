"""A small HTML tree: elements, direct text, and text blocks, in page order.

It follows the parts of the HTML rules that matter for text: void elements,
raw-text elements, implied ends of paragraphs, list items and table cells, and
end tags that close what is open inside them.  A tag that never ends is text; a
quote in a tag that never ends is an ordinary character there.  Any page is read in
time linear in its length: no tag is looked for behind the last ``>``, an open quote
is met once, and open elements are found by their tags.
"""

from __future__ import annotations

import re
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
                      "h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
_IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}, "thead": {"tr", "td", "th", "tbody"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
_SCOPE = frozenset("ul ol dl table body html article section div main aside select td th".split())
_COMMENT_END = re.compile(r"-->|\Z")
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Node:
    __slots__ = ("tag", "attrs", "parent", "depth", "order", "children")

    def __init__(self, tag: str, attrs: str, parent: int, depth: int) -> None:
        self.tag, self.attrs, self.parent, self.depth = tag, attrs, parent, depth


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)} if raw and not raw.isspace() else {}


class _Open:
    """The open elements, and by tag where they are in the stack."""

    def __init__(self, nodes: list[Node]) -> None:
        self.nodes, self.stack = nodes, [0]
        self.at: dict[str, list[int]] = {}
        self.blocks = [0]               # places of elements that are not inline

    def push(self, own: int, tag: str) -> None:
        place = len(self.stack)
        self.at.setdefault(tag, []).append(place)
        if tag not in INLINE:
            self.blocks.append(place)
        self.stack.append(own)

    def place(self, tag: str) -> int:
        """Where the innermost open element of this tag is; 0 if there is none."""
        places = self.at.get(tag)
        return places[-1] if places else 0

    def cut(self, place: int) -> None:
        """Close this element and all inside it."""
        for i in self.stack[place:]:
            self.at[self.nodes[i].tag].pop()
        del self.stack[place:]
        while self.blocks[-1] >= place:
            self.blocks.pop()

    def close(self, tags: set[str], pieces: list) -> None:
        """End open elements of these tags within the current scope."""
        place = max(map(self.place, tags))
        scope = max(map(self.place, _SCOPE - tags)) if place else 0
        while place > scope:
            pieces.append((self.stack[place], None))
            self.cut(place)
            place = max(map(self.place, tags))


class _Tags:
    """Finds the ends of a page's tags."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = page.rfind(">")
        self.plain = -1                 # up to here quotes are ordinary characters

    def end(self, start: int, at: int) -> int:
        """The end of the tag that starts at ``start`` and whose name ends at ``at``."""
        page = self.page
        if start <= self.plain:
            return page.find(">", at) + 1
        while (m := _STOP.search(page, at)) and m[0] != ">":
            at = page.find(m[0], m.end()) + 1
            if at == 0:
                self.plain = m.start()
                break
        else:
            if m:
                return m.end()
            self.plain = len(page)
        return page.find(">", start) + 1


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Elements (the first is a root) and (element, text) pieces; a piece whose
    text is None is a block border.  Raw-text elements keep no text."""
    nodes = [Node("#root", "", -1, 0)]
    pieces: list[tuple[int, str | None]] = []
    tree, tags = _Open(nodes), _Tags(page)
    stack = tree.stack
    at = text = 0

    def flush(upto: int) -> None:
        if upto > text:
            run = page[text:upto]
            pieces.append((stack[-1], unescape(run) if "&" in run else run))

    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            flush(start)
            at = text = _COMMENT_END.search(page, start + 4).end()
            continue
        if start > tags.last:
            after = page.find("<!--", start)    # no tag ends behind here; a comment may be open
            if after < 0:
                break
            at = after
            continue
        if page[start + 1:start + 2] in ("!", "?"):
            flush(start)
            at = text = page.find(">", start) + 1
            continue
        name = _NAME.match(page, start + 1)
        if name is None:
            at = start + 1
            continue
        flush(start)
        end = tags.end(start, name.end())
        tag = page[start + 1:min(name.end(), end - 1)].lower()
        raw = page[name.end():end - 1]
        at = text = end
        if tag[0] == "/":
            tag = tag[1:]
            if tag == "p" and not tree.place("p"):
                pieces.append((stack[-1], None))
                continue
            place = tree.place(tag)
            if place and (tag not in INLINE or place > tree.blocks[-1]):    # an inline end tag does not close a block
                if tree.blocks[-1] >= place:
                    pieces.append((stack[place], None))
                tree.cut(place)
            continue
        if tag in _CLOSES_P:
            tree.close({"p"}, pieces)
        if tag in _IMPLIED:
            tree.close(_IMPLIED[tag], pieces)
        nodes.append(Node(tag, raw, stack[-1], len(stack)))
        own = len(nodes) - 1
        if tag not in INLINE:
            pieces.append((stack[-1], None))
        elif tag == "br":
            pieces.append((stack[-1], " "))
        if tag in RAW:
            stop = _RAW_END[tag].search(page, at)
            at = text = stop.end() if stop else len(page)
        elif tag not in VOID and not raw.endswith("/"):
            tree.push(own, tag)
    flush(len(page))
    return nodes, pieces
