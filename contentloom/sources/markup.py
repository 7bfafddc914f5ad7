"""A small HTML outline with the selector forms the page profiles use.

Runs inside tasks, one page at a time. Selectors: ``tag``, ``.class``, ``[class="text"]``,
``[class*="part" i]``, any mix of these on one element, descendant and child combinators, and
comma lists.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

# Elements without content, and elements whose text is not page text.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
SILENT_TAGS = frozenset(("script", "style", "template", "rt", "rp"))


class Element:
    __slots__ = ("tag", "attrs", "classes", "parent", "number", "last", "text_from", "text_to")

    def __init__(self, tag, attrs, parent, number, text_from):
        self.tag = tag
        self.attrs = attrs
        self.classes = (attrs.get("class") or "").split()
        self.parent = parent
        self.number = number
        self.last = number
        self.text_from = text_from
        self.text_to = text_from


class _Enough(Exception):
    """The wanted elements are complete."""


class Outline(HTMLParser):
    """Elements in document order; the descendants of one are a contiguous range.

    With ``first=(selector, count)`` reading ends as soon as the first ``count`` matches are
    complete, so the rest of a long page costs nothing. A page with fewer is read to its end.
    """

    def __init__(self, html: str, first: tuple[str, int] | None = None):
        super().__init__(convert_charrefs=True)
        self._wanted = compile_selector(first[0]) if first else ()
        self._missing = first[1] if first else 0
        self._incomplete: set[int] = set()
        self.elements: list[Element] = []
        self._texts: list[str] = []
        self._open: list[Element] = []
        self._open_tags: dict[str, int] = {}
        self._silent = 0
        try:
            self.feed(html)
            self.close()
        except _Enough:
            pass
        self._incomplete.clear()
        while self._open:
            self._finish()

    def handle_starttag(self, tag, attrs):
        parent = self._open[-1] if self._open else None
        named: dict[str, str] = {}
        for key, value in attrs:
            named[key] = value or ""
        element = Element(tag, named, parent, len(self.elements), len(self._texts))
        self.elements.append(element)
        self._open.append(element)
        if self._missing and any(_matches(element, steps) for steps in self._wanted):
            self._missing -= 1
            self._incomplete.add(element.number)
        self._open_tags[tag] = self._open_tags.get(tag, 0) + 1
        self._silent += tag in SILENT_TAGS
        if tag in VOID_TAGS:
            self._finish()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._finish()

    def handle_endtag(self, tag):
        if self._open_tags.get(tag):
            while self._finish() != tag:
                pass

    def handle_data(self, data):
        if not self._silent:
            self._texts.append(data)

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self.handle_data(data[6:])

    def parse_marked_section(self, i, report=1):
        """A section of an unknown kind counts as a comment that ends at the next ``>``."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            end = self.rawdata.find(">", i)
            return end + 1 if end >= 0 else -1

    def _finish(self) -> str:
        element = self._open.pop()
        element.last = len(self.elements) - 1
        element.text_to = len(self._texts)
        self._open_tags[element.tag] -= 1
        self._silent -= element.tag in SILENT_TAGS
        if element.number in self._incomplete:
            self._incomplete.remove(element.number)
            if not self._missing and not self._incomplete:
                raise _Enough
        return element.tag

    def text(self, element: Element | None = None) -> str:
        if element is None:
            return "".join(self._texts)
        return "".join(self._texts[element.text_from : element.text_to])

    def select(self, selector: str, scope: Element | None = None):
        """Matching descendants of ``scope`` (of the page when absent) in document order.

        Ancestors named by the selector may lie outside the scope.
        """
        alternatives = compile_selector(selector)
        first, last = (
            (0, len(self.elements) - 1) if scope is None else (scope.number + 1, scope.last)
        )
        for number in range(first, last + 1):
            element = self.elements[number]
            if any(_matches(element, steps) for steps in alternatives):
                yield element

    def first(self, selectors, scope: Element | None = None) -> Element | None:
        """First match of the first selector that has one."""
        for selector in selectors:
            for element in self.select(selector, scope):
                return element
        return None


_SIMPLE = re.compile(
    r"""(?P<tag>[a-zA-Z][\w-]*)
      | \.(?P<cls>[\w-]+)
      | \[class="(?P<is>[^"]*)"\]
      | \[class\*="(?P<has>[^"]*)"\si\]""",
    re.VERBOSE,
)
_PIECE = re.compile(r"\s*(>)\s*|(\s+)|((?:\[[^\]]*\]|[^\s>\[])+)")


_COMPILED: dict[str, tuple] = {}


def compile_selector(selector: str) -> tuple:
    """Alternatives of a selector; the few selectors of the profiles are compiled once a task."""
    if selector not in _COMPILED:
        _COMPILED[selector] = tuple(_compile_steps(part) for part in selector.split(","))
    return _COMPILED[selector]


def _compile_steps(part: str) -> tuple:
    """Steps from the element itself outwards, each with how it is tied to the one before."""
    steps = []
    tie = None
    for child, blank, compound in _PIECE.findall(part.strip()):
        if compound:
            steps.append((_compile_compound(compound), tie))
        tie = ">" if child else " "
    if not steps:
        raise ValueError(f"empty selector in {part!r}")
    return tuple(reversed(steps))


def _compile_compound(text: str) -> tuple:
    tests = []
    position = 0
    while position < len(text):
        found = _SIMPLE.match(text, position)
        if not found:
            raise ValueError(f"unsupported selector {text!r}")
        value = found.group(found.lastgroup)
        tests.append((found.lastgroup, value.lower() if found.lastgroup in ("tag", "has") else value))
        position = found.end()
    return tuple(tests)


def _fits(element: Element, tests: tuple) -> bool:
    for kind, value in tests:
        if kind == "tag":
            if element.tag != value:
                return False
        elif kind == "cls":
            if value not in element.classes:
                return False
        else:
            joined = " ".join(element.classes)
            if (joined != value) if kind == "is" else (value not in joined.lower()):
                return False
    return True


def _matches(element: Element, steps: tuple) -> bool:
    tests, tie = steps[0]
    if not _fits(element, tests):
        return False
    outer = steps[1:]
    if not outer:
        return True
    ancestor = element.parent
    if tie == ">":
        return ancestor is not None and _matches(ancestor, outer)
    while ancestor is not None:
        if _matches(ancestor, outer):
            return True
        ancestor = ancestor.parent
    return False


def page_text(html: str) -> str:
    """All text of a page or fragment, without script, style and comment content.

    What the reader cannot take stays as it is, so that one odd text costs no other row.
    """
    try:
        return Outline(html).text()
    except (AssertionError, ValueError, RecursionError):
        return html
