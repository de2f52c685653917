"""A small tolerant HTML reader: blocks of a page as a tree, and the texts between them in page order."""

from __future__ import annotations

import re
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements inside a line; their text belongs to the block around them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var br wbr img"
    " math mi mn mo ms mtext mspace mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mstyle mpadded mphantom menclose"
    " mfenced mtable mtr mtd semantics annotation".split()
)
#: Elements whose content is never read as text. What others show in place of something else (noscript, object, video) is read.
HIDDEN = frozenset("head script style template svg iframe title select datalist textarea".split())
RAW = frozenset("script style textarea title iframe template".split())
#: Elements that do not open a body where there is none.
_HEADS = frozenset("html head body base link meta title style script noscript template frameset frame".split())
#: Open elements that a start tag closes, up to the nearest of the elements after them.
_BLOCK_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr main menu nav ol p pre section table ul".split()
)
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "body": ({"head"}, set()),
}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_PLAIN = re.compile(r"[^\"'>]*")
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_KEPT = frozenset(("class", "id", "role"))


class Block:
    """A block element: its parent's number, tag, words of class, id and role, depth, and what lies below it."""

    __slots__ = ("parent", "tag", "tokens", "depth", "hidden", "chars", "link_chars", "own_chars", "words", "marks", "chunks", "elements", "paragraphs", "items", "start", "end", "place", "children")

    def __init__(self, parent: int, tag: str, tokens: list[str], depth: int, hidden: bool, start: int):
        self.parent, self.tag, self.tokens, self.depth, self.hidden, self.start = parent, tag, tokens, depth, hidden, start
        self.chars = self.link_chars = self.own_chars = self.words = self.marks = self.chunks = 0
        self.elements = self.paragraphs = self.items = 0
        self.end = start
        self.place = 0  # among its parent's children
        self.children: list[int] = []


def _tokens(attributes: str) -> list[str]:
    found = []
    for m in _ATTR.finditer(attributes):
        if m[1].lower() in _KEPT:
            value = m[2] or m[3] or m[4] or ""
            found += [t.lower() for t in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", value)]
    return found


def read(html: str | None) -> tuple[list[Block], list[tuple[int, str]]]:
    """Blocks in page order, the first one the page itself, and runs of text as (block, decoded text)."""
    html = html or ""
    blocks = [Block(-1, "#page", [], 0, False, 0)]
    runs: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements with the block they are in
    pending: list[str] = []
    links = hidden = 0
    total = 0
    no_quote: set[str] = set()
    opened: dict[str, int] = {}

    def flush() -> None:
        if pending:
            text = " ".join("".join(pending).split())
            if text:
                runs.append((stack[-1][1], text))
            pending.clear()

    def start(tag: str, attributes: str = "") -> None:
        nonlocal hidden
        parent = stack[-1][1]
        block = Block(parent, tag, _tokens(attributes), blocks[parent].depth + 1, bool(hidden) or tag in HIDDEN, total)
        block.place = len(blocks[parent].children)
        blocks[parent].children.append(len(blocks))
        blocks.append(block)
        opened[tag] = opened.get(tag, 0) + 1
        stack.append((tag, len(blocks) - 1))
        hidden += tag in HIDDEN

    def imply_body() -> None:
        """Text and most elements outside a body are in one all the same; they end an open head."""
        if opened.get("body") or stack[-1][0] not in ("#page", "html", "head"):
            return
        flush()
        if stack[-1][0] == "head":
            close()
        for tag in ("html", "body")[stack[-1][0] == "html" :]:
            blocks[stack[-1][1]].elements += 1
            start(tag)

    def imply_line() -> None:
        """Text right in the body is a paragraph of its own, up to the next block."""
        imply_body()
        if stack[-1][0] == "body":
            flush()
            blocks[stack[-1][1]].elements += 1
            start("p")

    def text_at(raw: str) -> None:
        nonlocal total
        if raw and stack[-1][0] in ("#page", "html", "head", "body") and not raw.isspace():
            imply_line()
        if not raw or hidden:
            return
        text = unescape(raw) if "&" in raw else raw
        pending.append(text)
        stripped = text.strip()
        if stripped:
            block = blocks[stack[-1][1]]
            n = len(stripped)
            total += n
            block.own_chars += n
            block.chunks += 1
            block.words += stripped.count(" ") + 1
            block.marks += sum(map(stripped.count, ".,;:!?"))
            if links:
                block.link_chars += n

    def close() -> None:
        nonlocal links, hidden
        tag, at = stack.pop()
        opened[tag] -= 1
        if tag == "a":
            links -= 1
        if tag in HIDDEN:
            hidden -= 1
        if tag not in INLINE:
            blocks[at].end = total

    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            text_at(html[at:])
            break
        if lt > at:
            text_at(html[at:lt])
        if html.startswith("<!--", lt):
            stop = html.find("-->", lt + 4)
            at = n if stop < 0 else stop + 3
            continue
        if html.startswith(("<!", "<?"), lt):
            stop = html.find(">", lt)
            at = n if stop < 0 else stop + 1
            continue
        ending = html.startswith("</", lt)
        m = _NAME.match(html, lt + 1 + ending)
        if not m:
            text_at("<")
            at = lt + 1
            continue
        tag, begin = m[0].lower(), m.end()
        stop = begin
        while True:
            stop = _PLAIN.match(html, stop).end()
            if stop >= n or html[stop] == ">":
                break
            quote = html[stop]
            after = -1 if quote in no_quote else html.find(quote, stop + 1)
            if after < 0:  # an open quote: the tag ends at the next bracket
                no_quote.add(quote)
                stop = html.find(">", stop)
                stop = n if stop < 0 else stop
                break
            stop = after + 1
        attributes, at = html[begin:stop], min(n, stop + 1)
        inline = tag in INLINE
        if tag in ("html", "body") and (ending or opened.get(tag)):  # what follows is in the body too
            flush()
            continue
        if ending:
            if opened.get(tag) and (not inline or _same_block(stack, tag)):
                if not inline:
                    flush()
                while stack[-1][0] != tag:
                    close()
                close()
            elif not inline:
                flush()
            continue
        if inline and tag not in VOID:
            imply_line()
        elif tag not in _HEADS:
            imply_body()
        if tag == "br":
            pending.append(" ")
            continue
        if not inline:
            flush()
            ends, limits = _CLOSES.get(tag, (frozenset(), frozenset()))
            if tag in _BLOCK_ENDS_P:
                ends, limits = ends | {"p"}, limits | {"table", "td", "th", "button"}
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in limits:
                    break
                if stack[k][0] in ends:
                    while len(stack) > k:
                        close()
                    break
                if stack[k][0] not in INLINE and stack[k][0] not in ends and tag in _BLOCK_ENDS_P:
                    break
        parent = stack[-1][1]
        blocks[parent].elements += 1
        if tag in VOID:
            continue
        if inline:
            opened[tag] = opened.get(tag, 0) + 1
            stack.append((tag, parent))
            links += tag == "a"
            continue
        start(tag, attributes)
        if attributes.endswith("/") and tag in ("svg", "iframe"):
            close()
        elif tag in RAW:
            stop = re.compile(f"</{re.escape(tag)}", re.I).search(html, at)
            at = stop.start() if stop else n
    flush()
    while len(stack) > 1:
        close()
    blocks[0].end = total
    for b in reversed(blocks):  # children come after their parent
        b.chars += b.own_chars
        b.paragraphs += b.tag in ("p", "blockquote", "pre")
        b.items += b.tag in ("li", "option", "dd", "td")
        if b.parent >= 0:
            up = blocks[b.parent]
            for name in ("chars", "link_chars", "words", "marks", "chunks", "elements", "paragraphs", "items"):
                setattr(up, name, getattr(up, name) + getattr(b, name))
    return blocks, runs


def _same_block(stack: list[tuple[str, int]], tag: str) -> bool:
    """Whether an open inline element of this name belongs to the current block."""
    here = stack[-1][1]
    for t, b in reversed(stack):
        if t == tag:
            return True
        if b != here or t not in INLINE:
            return False
    return False
