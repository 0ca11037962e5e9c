"""Reading HTML as a tree of elements and runs of text.

The reader follows what browsers do where it matters for text: comments,
declarations and raw elements (scripts, styles) hold none, end tags that are missing
are implied, unknown end tags are skipped, character references are decoded. It is
linear in the length of the page, whatever the markup.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape

#: Element names as HTML defines them.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option"
    " p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: An element in the first list ends an open one of the second, up to the nearest of the third.
_ENDS = (
    (BLOCK - {"br", "option", "optgroup", "html", "head", "body"}, {"p"}, {"button", "table", "td", "th", "caption", "object"}),
    ({"li"}, {"li"}, {"ul", "ol", "menu", "dir"}),
    ({"dt", "dd"}, {"dt", "dd"}, {"dl"}),
    ({"option", "optgroup"}, {"option"}, {"select"}),
    ({"td", "th"}, {"td", "th"}, {"tr", "table"}),
    ({"tr"}, {"td", "th", "tr"}, {"table"}),
    ({"tbody", "thead", "tfoot"}, {"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}),
    ({"body"}, {"head"}, set()),
    ({"h1", "h2", "h3", "h4", "h5", "h6"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"section", "article", "div", "td"}),
)
_ENDED_BY = {tag: [(ended, stops) for opens, ended, stops in _ENDS if tag in opens] for tag in BLOCK}

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"  # a comment
    r"|<[!?][^>]*+(?:>|\Z)|</(?=[^a-zA-Z])[^>]*+(?:>|\Z)"  # a declaration, or an end tag that is none
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|))*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"([^\s\"'<>/=]+)\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s\"'<>=`]++))|([^\s\"'<>/=]+)", re.DOTALL
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE) for tag in RAW}


def attributes(source: str) -> dict[str, str]:
    """Attributes of a tag; names in lower case, the first of a name counts."""
    found: dict[str, str] = {}
    for name, double, single, plain, alone in _ATTRIBUTE.findall(source):
        found.setdefault((name or alone).lower(), unescape(double or single or plain))
    return found


class Page:
    """Elements in page order, each with its parent, and the runs of text in them.

    Element 0 is the page itself. A parent's number is below its children's. An
    item of ``items`` is the text (str) or child (int) of an element, in order.
    """

    def __init__(self, html: str):
        self.tag, self.parent, self.source, self.items = ["#page"], [0], [""], [[]]
        self.title = ""
        self._read(html)

    def _read(self, html: str) -> None:
        open_: list[int] = [0]
        depths: dict[str, list[int]] = {}  # of open elements, by name; "" has those of all blocks
        at = 0

        def deepest(names) -> int:
            return max((depths[n][-1] for n in names if depths.get(n)), default=0)

        def close_to(depth: int) -> None:
            for node in open_[depth:]:
                tag = self.tag[node]
                depths[tag].pop()
                if tag in BLOCK:
                    depths[""].pop()
            del open_[depth:]

        while at < len(html):
            found = _TOKEN.search(html, at)
            stop = found.start() if found else len(html)
            if stop > at:
                self.items[open_[-1]].append(unescape(html[at:stop]))
            if not found:
                break
            at = found.end()
            closing, name, source = found.groups()
            if name is None:
                continue
            name = name.lower()
            if closing:
                depth = deepest((name,))
                # An inline end tag doesn't end the block around it.
                if depth and (name in BLOCK or depth > deepest(("",))):
                    close_to(depth)
                elif name in ("br", "p"):
                    self.items[open_[-1]].append(" ")
                continue
            for ended, stops in _ENDED_BY.get(name, ()):
                depth = deepest(ended)
                if depth > deepest(stops):
                    close_to(depth)
            node = len(self.tag)
            self.tag.append(name)
            self.parent.append(open_[-1])
            self.source.append(source)
            self.items.append([])
            self.items[open_[-1]].append(node)
            if name in VOID or source.endswith("/") and name not in BLOCK and name not in RAW:
                continue
            depths.setdefault(name, []).append(len(open_))
            if name in BLOCK:
                depths.setdefault("", []).append(len(open_))
            open_.append(node)
            if name in RAW:
                end = _RAW_END[name].search(html, at)
                stop = end.start() if end else len(html)
                if name == "title" and not self.title:
                    self.title = " ".join(unescape(html[at:stop]).split())
                at = stop

    def digests(self) -> list[bytes]:
        """A 128-bit hash of each element's subtree: names, structure and text, no attributes."""
        out: list[bytes] = [b""] * len(self.tag)
        for node in range(len(self.tag) - 1, -1, -1):
            state = blake2b(self.tag[node].encode(), digest_size=16)
            words: list[str] = []
            for item in [*self.items[node], 0]:
                if isinstance(item, str):
                    words.append(item)
                    continue
                text = " ".join("".join(words).split())
                if text:
                    state.update(b"\x00" + text.encode("utf-8", "surrogatepass") + b"\x01")
                words = []
                if item:
                    state.update(out[item])
            out[node] = state.digest()
        return out

    def has_text(self) -> list[bool]:
        """Whether anything but white space is inside each element."""
        out = [any(isinstance(i, str) and not i.isspace() for i in items) for items in self.items]
        for node in range(len(out) - 1, 0, -1):
            if out[node]:
                out[self.parent[node]] = True
        return out

    def text(self, dropped: list[bool], chosen: list[bool]) -> str:
        """Text of the chosen elements without what lies in dropped ones, blocks apart by one space."""
        parts: list[str] = []
        stack: list = [0]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
                continue
            node, begun = item if isinstance(item, tuple) else (item, False)
            apart = self.tag[node] in BLOCK
            if apart:
                parts.append(" ")
            if begun or dropped[node]:
                continue
            stack.append((node, True))
            keep = chosen[node]
            stack.extend(i for i in reversed(self.items[node]) if keep or not isinstance(i, str))
        return " ".join("".join(parts).split())
