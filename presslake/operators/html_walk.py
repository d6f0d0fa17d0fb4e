"""Main text of a page by a tag stack and the density of its blocks: ``html_extract(fn=walk_pages)``.

One pass over the page keeps a stack of open elements. A closing tag closes the nearest open element of its name with
all that was left open inside it, and none if there is no such element, so forgotten and stray tags do no harm beyond
the element they stand in. Elements that are furniture by name or by their class, id or role are left out with all they
hold; a header inside an article stays.

What is left is cut into blocks: headings, paragraphs, list items, table rows. A block's weight is its words less
twice those inside links, so menus weigh nothing or less. Blocks lie in boxes (``div``, ``section``, ``td``, ...); a
box weighs what its own blocks weigh, and half of what lies in the boxes directly inside. The text is the heaviest
box, or the article if there is one, from its first block to its last, without blocks that are mostly links.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd

# Elements left out with all they hold, elements without an end, and those that hold blocks.
FURNITURE = {"head", "script", "style", "noscript", "template", "svg", "iframe", "nav", "aside", "footer", "button",
             "select", "textarea", "figure", "object", "audio", "video", "canvas"}
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BOXES = {"html", "body", "div", "section", "article", "main", "td", "th", "form", "header", "blockquote", "center"}
BREAKS = BOXES | {"p", "ul", "ol", "li", "dl", "dt", "dd", "table", "tbody", "thead", "tr", "pre", "h1", "h2", "h3",
                  "h4", "h5", "h6", "address", "fieldset"}
# What an opening tag closes, if it is open in the same list, table or box.
CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
KEEPS = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "form", "blockquote"}
# Words in class, id or role that mark furniture.
_HINTS = re.compile(
    r"(?:^|[\s_-])(?:menu|nav|navbar|navigation|breadcrumbs?|sidebar|footer|ads?|advert|advertisement|banner|cookies?|"
    r"share|sharing|social|related|promo|newsletter|comments?|search|login|popup|modal)(?:$|[\s_-])", re.IGNORECASE,
)
_MARKS = {f"h{n}": "#" * n + " " for n in range(1, 7)} | {"li": "- ", "tr": "| "}


@dataclass
class Block:
    """A line of text to be: its mark, its pieces, its box and how many of its characters are in links."""

    box: int
    mark: str = ""
    pieces: list[str] = field(default_factory=list)
    in_links: int = 0

    def text(self) -> str:
        return re.sub(r"\s+", " ", "".join(self.pieces)).strip()


@dataclass
class Open:
    tag: str
    box: int
    dropped: bool


class _Scanner(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack = [Open("", 0, False)]
        self.boxes = [(-1, "")]  # parent and name
        self.blocks = [Block(0)]
        self.links = 0
        self.rows = 0

    def _break(self, mark: str = "") -> None:
        if self.rows and not mark:
            return  # a table row is one line, whatever its cells hold
        self.blocks.append(Block(self.stack[-1].box, mark))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in EMPTY:
            if tag in ("br", "hr") and not self.stack[-1].dropped:
                self._break()
            return
        self._close_forgotten(tag)
        top = self.stack[-1]
        named = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        dropped = top.dropped or tag in FURNITURE or (tag not in ("html", "body", "article", "main") and bool(_HINTS.search(named)))
        dropped |= tag == "header" and not any(o.tag in ("article", "main") for o in self.stack)
        box = top.box
        if tag in BOXES and not dropped and not self.rows:
            self.boxes.append((top.box, tag))
            box = len(self.boxes) - 1
        self.stack.append(Open(tag, box, dropped))
        if not dropped:
            self.links += tag == "a"
            if tag in BREAKS:
                self._break(_MARKS.get(tag, ""))
            self.rows += tag == "tr"

    def _close_forgotten(self, tag: str) -> None:
        closes = CLOSES.get(tag, {"p", "head"} if tag in BREAKS else set())  # a head may end without a tag of its own
        for at in range(len(self.stack) - 1, 0, -1):
            name = self.stack[at].tag
            if name in closes:
                self._pop(at)
            elif name in KEEPS:
                break

    def _pop(self, at: int) -> None:
        """Close the element at this height and all above it."""
        for gone in reversed(self.stack[at:]):
            if not gone.dropped:
                if gone.tag in ("td", "th") and self.rows:
                    self.blocks[-1].pieces.append(" | ")
                self.links -= gone.tag == "a"
                self.rows -= gone.tag == "tr"
        ends_line = any(o.tag in BREAKS and not o.dropped for o in self.stack[at:])
        del self.stack[at:]
        if ends_line:
            self._break()

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == tag:
                self._pop(at)
                return

    def handle_data(self, data: str) -> None:
        if not self.stack[-1].dropped:
            block = self.blocks[-1]
            block.pieces.append(data)
            block.in_links += len(data.strip()) if self.links else 0


def _main_box(boxes: list[tuple[int, str]], blocks: list[tuple[int, str, float]]) -> int:
    """The article of most weight, else the box of most weight."""
    own = [0.0] * len(boxes)
    for box, _, weight in blocks:
        own[box] += weight
    inside = list(own)
    for box in range(len(boxes) - 1, 0, -1):  # a box comes after the one it lies in
        inside[boxes[box][0]] += inside[box]
    whole = [(inside[b], -b) for b, (_, name) in enumerate(boxes) if name in ("article", "main") and inside[b] > 0]
    if whole:
        return -max(whole)[1]
    near = list(own)
    for box in range(1, len(boxes)):
        near[boxes[box][0]] += 0.5 * own[box]
    return max(range(len(boxes)), key=lambda b: (near[b], b))


def walk_page(html: str | None) -> str | None:
    """Text of one page as light markdown, or None."""
    if not html:
        return None
    scanner = _Scanner()
    scanner.feed(html)
    scanner.close()
    found = []
    for block in scanner.blocks:
        text = block.text()
        if text.strip("| "):
            links = min(1.0, block.in_links / max(1, len(text)))
            found.append((block.box, (block.mark + text).strip(), len(text.split()) * (1 - 2 * links)))
    if not found:
        return None
    main, boxes = _main_box(scanner.boxes, found), scanner.boxes

    def lies_in(box: int) -> bool:
        while box > main:
            box = boxes[box][0]
        return box == main

    kept = [line for box, line, weight in found if weight > 0 and lies_in(box)]
    return "\n".join(kept) or None


def walk_pages(html: pd.Series) -> pd.Series:
    return html.map(walk_page, na_action=None)
