"""Reads the texts and attributes of selected elements from one HTML page.

A helper for the per-page step of the extraction jobs. A selector is a path of steps such as
``#tags > a`` or ``span.time-date``; a step names a tag, an id, classes or one attribute value.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

STEP = re.compile(r"([\w*-]*)(?:#([\w-]+))?((?:\.[\w-]+)*)(?:\[([\w-]+)='([^']*)'\])?$")
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = {"script", "style"}
# Tags that end an open paragraph.
BLOCK = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
            "main nav ol p pre section table ul".split())
INNER_SPACE = re.compile(r"[^\S\n]+")
LINE_SPACE = re.compile(r" ?\n ?")


class Step:
    """One compound of a selector, and whether it must be the direct child of the step before."""

    def __init__(self, text: str, child: bool):
        tag, self.id, classes, self.attr, self.value = STEP.match(text).groups()
        self.tag = None if tag in ("", "*") else tag
        self.classes = set(classes.split(".")[1:])
        self.child = child

    def fits(self, element: tuple[str, dict]) -> bool:
        tag, attrs = element
        return (
            (self.tag is None or self.tag == tag)
            and (self.id is None or attrs.get("id") == self.id)
            and self.classes <= set((attrs.get("class") or "").split())
            and (self.attr is None or attrs.get(self.attr) == self.value)
        )


def steps(selector: str) -> list[Step]:
    """Parts of a selector, outermost first."""
    parts, child = [], False
    for word in selector.split():
        if word == ">":
            child = True
        else:
            parts.append(Step(word, child))
            child = False
    return parts


class Picker(HTMLParser):
    """Collects ``(text, attributes)`` of every element that fits a selector, in page order.

    Every open element carries, per selector, which of its steps end in it and which end in it or above it, as bits,
    and every tag knows where it is open. So a tag costs by the selectors, however deep a broken page nests.
    """

    def __init__(self, paths: dict[str, list[Step]]):
        super().__init__(convert_charrefs=True)
        self.paths = paths
        self.found = {name: [] for name in paths}
        self.stack = []  # (tag, bits of steps that end here, bits of steps that end here or above) of open elements
        self.places = {}  # depths at which a tag is open
        self.open = []  # (stack depth, text pieces) of elements being collected

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.handle_data("\n", verbatim=True)
        if tag in BLOCK:
            self.end("p")
        if tag == "li":
            self.end("li", within={"ul", "ol"})
        element = (tag, dict(attrs))
        parent, above = self.stack[-1][1:] if self.stack else ({}, {})
        here, both = {}, {}
        for name, path in self.paths.items():
            bits = 0
            for at, step in enumerate(path):
                before = (parent if step.child else above).get(name, 0) >> (at - 1) & 1 if at else 1
                if before and step.fits(element):
                    bits |= 1 << at
            here[name], both[name] = bits, bits | above.get(name, 0)
        self.stack.append((tag, here, both))
        self.places.setdefault(tag, []).append(len(self.stack))
        for name, path in self.paths.items():
            if here[name] >> (len(path) - 1) & 1:
                pieces = []
                self.found[name].append((pieces, element[1]))
                self.open.append((len(self.stack), pieces))
        if tag in VOID:
            self.end(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.end(tag)

    def handle_endtag(self, tag):
        self.end(tag)

    def end(self, tag: str, within: set[str] = frozenset()):
        """Close the innermost open ``tag`` and all it contains, not looking beyond ``within``."""
        depths = self.places.get(tag)
        if not depths or any(self.places.get(w, [0])[-1:] > depths[-1:] for w in within):
            return
        depth = depths[-1]
        while len(self.stack) >= depth:
            self.places[self.stack.pop()[0]].pop()
        while self.open and self.open[-1][0] >= depth:
            self.open.pop()

    def handle_data(self, data, verbatim: bool = False):
        if self.stack and self.stack[-1][0] in HIDDEN:
            return
        if not verbatim:
            data = re.sub(r"\s+", " ", data)
        for _, pieces in self.open:
            pieces.append(data)


def squash(pieces: list[str]) -> str:
    """Text with runs of spaces squashed; line breaks stay."""
    text = INNER_SPACE.sub(" ", "".join(pieces))
    return LINE_SPACE.sub("\n", text).strip()


def pick(html: str | None, paths: dict[str, list[Step]]) -> dict[str, list[tuple[str, dict]]]:
    """Texts and attributes per selector name."""
    picker = Picker(paths)
    picker.feed(html or "")
    picker.close()
    return {name: [(squash(pieces), attrs) for pieces, attrs in hits]
            for name, hits in picker.found.items()}
