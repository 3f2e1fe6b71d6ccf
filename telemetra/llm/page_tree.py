"""HTML as a tree of blocks: what wrappers are inferred from and applied to."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

# Elements that stand as blocks; all others run within a line of text.
BLOCKS = frozenset(
    "html head body title header footer nav main article section aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption"
    " thead tbody tfoot tr td th blockquote pre figure figcaption address form fieldset legend details summary dialog hr hgroup"
    " menu search center button select option textarea noscript template svg iframe object video audio canvas".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
# An opening tag ends an open element of these, up to the given borders.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BORDERS = frozenset("ul ol dl table select article section div body".split())
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
NAMED = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
CLASS = re.compile(r"[A-Za-z]+(?:[-_]+[A-Za-z]+)*")
RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE) for name in RAW}
TEXT, LINKS = "#", "#a"
# Elements nested deeper stand beside each other at this depth, as browsers do it.
MAX_DEPTH = 150


class Block:
    """An element with a key (its name and classes), or a run of text with the key # (or #a, if all of it is links)."""

    __slots__ = ("children", "key", "text")

    def __init__(self, key: str, text: str = "") -> None:
        self.key, self.text, self.children = key, text, []


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes): kind is < for an opening tag, / for a closing one, # for text."""
    at, size = 0, len(page)
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            yield TEXT, page[at:], ""
            return
        if tag > at:
            yield TEXT, page[at:tag], ""
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = size if end < 0 else end + 3
            continue
        follows = page[tag + 1 : tag + 3]
        if follows[:1] in ("!", "?") or (follows[:1] == "/" and not follows[1:].isalpha()):
            end = page.find(">", tag)
            at = size if end < 0 else end + 1
            continue
        if not (follows[:1].isascii() and follows[:1].isalpha()) and follows[:1] != "/":
            yield TEXT, "<", ""
            at = tag + 1
            continue
        match = TAG.match(page, tag)
        if match is None:
            # A quote that never ends: the tag ends at the next bracket, or takes what is left of the page.
            end = page.find(">", tag)
            if end < 0:
                return
            name = re.match(r"/?([A-Za-z][^\s/>]*)", page[tag + 1 : end])
            yield ("/" if follows[0] == "/" else "<"), name.group(1).lower() if name else "", ""
            at = end + 1
            continue
        closing, name, attributes = match.groups()
        name = name.lower()
        yield ("/" if closing else "<"), name, attributes
        at = match.end()
        if name in RAW and not closing:
            end = RAW_END[name].search(page, at)
            at = size if end is None else end.start()


def _key(name: str, attributes: str) -> str:
    """An element's name with its classes, role and id, whole but for their digits. A section's id names a place to link to and says nothing."""
    if not attributes:
        return name
    found = [(kind.lower(), "".join(values)) for kind, *values in NAMED.findall(attributes)]
    words = {word.lower() for kind, value in found if kind != "id" or name != "section" for word in CLASS.findall(value)}
    return f"{name}.{'.'.join(sorted(words))}" if words else name


def parse(page: str | None) -> Block:
    """The blocks of a page. Missing end tags are added as browsers do; the text of scripts and the like is left out."""
    root = Block("")
    stack, names = [root], [""]
    run: list[str] = []
    linked = unlinked = False
    links = beyond = 0

    def end_run() -> None:
        nonlocal linked, unlinked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                stack[-1].children.append(Block(LINKS if linked and not unlinked else TEXT, text))
            run.clear()
        linked = unlinked = False

    for kind, name, attributes in _tokens(page or ""):
        if kind == TEXT:
            run.append(name)
            if not name.isspace():
                linked, unlinked = linked or links > 0, unlinked or links == 0
        elif name == "br":
            run.append(" ")
        elif name == "a":
            links = links + 1 if kind == "<" else max(0, links - 1)
        elif name not in BLOCKS:
            continue
        elif kind == "<":
            end_run()
            links = 0
            for i in range(len(names) - 1, 0, -1):
                if names[i] in CLOSES.get(name, ()) or names[i] == "p":
                    del stack[i:], names[i:]
                    beyond = 0
                elif names[i] in BORDERS:
                    break
            block = Block(_key(name, attributes))
            stack[-1].children.append(block)
            if len(stack) > MAX_DEPTH:
                beyond += name not in VOID
            elif name not in VOID:
                stack.append(block)
                names.append(name)
        else:
            end_run()
            links = 0
            if beyond:
                beyond -= 1
                continue
            for i in range(len(names) - 1, 0, -1):
                if names[i] == name:
                    del stack[i:], names[i:]
                    break
    end_run()
    return root
