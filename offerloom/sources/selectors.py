"""Elements of landed pages by CSS selectors, all selectors of a layout matched while the page is read.

A selector is cut at its combinators into steps. A step is a bit, and an element has
the bits of the steps that it ends: its own tag, classes and attributes fit, and the
step before is among the bits of its ancestors (a descendant) or of its parent (a
child). Each open element keeps the union of the bits above it, so matching takes one
look at an element, whatever the depth; texts lie in one list, and an element is a
range of it. Start tags repeat over cards and pages, so what they say and fit by
themselves is worked out once a worker, and forgotten when there are many.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser

#: Plain markup, between its brackets: a start tag with attributes in double quotes, or an end tag. What else there is, the standard parser reads.
_PLAIN = re.compile(r"""([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z_:@][-\w:.@]*(?:="[^"<>]*")?)*)[ \t\n\r\f]*(/?)|/([a-zA-Z][a-zA-Z0-9]*)""", re.A)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:@][-\w:.@]*)(?:="([^"<>]*)")?""", re.A)
_RAW = frozenset({"script", "style"})
_UNLIKE = (frozenset(HTMLParser.CDATA_CONTENT_ELEMENTS) | frozenset(getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ())) | {"plaintext"}) - _RAW
#: Fixed value: what is remembered of start tags that came before, at most.
_SEEN = 4096
_SIMPLE = re.compile(r"""(?P<tag>\*|[a-zA-Z][\w-]*)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)|\[(?P<name>[\w-]+)(?:(?P<op>[*^$~]?=)(?:"(?P<quoted>[^"]*)"|(?P<bare>[^\]\s"]+)))?\]""")
_GAP = re.compile(r"\s*(?P<child>>)\s*|\s+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("script style noscript template".split())
#: What a start tag ends, if that is the innermost open element.
ENDED_BY = {"li": {"li"}, "p": {"p"}, "option": {"option"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}

_FITS: dict[str, Callable[[str, str], bool]] = {
    "=": lambda have, want: have == want,
    "*=": lambda have, want: bool(want) and want in have,
    "^=": lambda have, want: bool(want) and have.startswith(want),
    "$=": lambda have, want: bool(want) and have.endswith(want),
    "~=": lambda have, want: want in have.split(),
}


@dataclass(frozen=True)
class _Step:
    tag: str = ""
    classes: frozenset[str] = frozenset()
    tests: tuple[tuple[str, str, str], ...] = ()
    before: int = -1
    child: bool = False

    def fits(self, tag: str, attributes: dict[str, str], classes: set[str]) -> bool:
        return (not self.tag or self.tag == tag) and self.classes <= classes and all(n in attributes and (not op or _FITS[op](attributes[n], v)) for n, op, v in self.tests)


class Selectors:
    """Compiled selectors; a text may list several, separated by commas."""

    def __init__(self, texts: Iterable[str]):
        self.steps: list[_Step] = []
        self.ends: dict[str, int] = {}
        for text in dict.fromkeys(texts):
            self.ends[text] = 0
            for one in text.split(","):
                self.ends[text] |= 1 << self._compiled(one.strip())
        self.free = sum(1 << i for i, step in enumerate(self.steps) if step.before < 0)
        self.bound = ~self.free
        self.fitting: dict[tuple[str, str | None], tuple[int, list[tuple[int, _Step]]]] = {}
        self.tags: dict[str, tuple[str, dict[str, str] | None, int, str]] = {}
        self.named: dict[int, list[str]] = {}

    def _compiled(self, text: str) -> int:
        at, before, child = 0, -1, False
        while True:
            tag, classes, tests, start = "", set(), [], at
            while found := _SIMPLE.match(text, at):
                at = found.end()
                if found["tag"]:
                    tag = "" if found["tag"] == "*" else found["tag"].lower()
                elif found["cls"]:
                    classes.add(found["cls"])
                elif found["id"]:
                    tests.append(("id", "=", found["id"]))
                else:
                    tests.append((found["name"].lower(), found["op"] or "", found["quoted"] if found["quoted"] is not None else found["bare"] or ""))
            if at == start:
                raise ValueError(f"not a selector: {text!r}")
            self.steps.append(_Step(tag, frozenset(classes), tuple(tests), before, child))
            before = len(self.steps) - 1
            if at == len(text):
                return before
            gap = _GAP.match(text, at)
            if not gap:
                raise ValueError(f"not a selector: {text!r}")
            at, child = gap.end(), gap["child"] is not None

    def fits(self, tag: str, attributes: dict[str, str]) -> int:
        """The steps that an element fits by itself; what tag and classes tell is remembered."""
        key = tag, attributes.get("class")
        found = self.fitting.get(key)
        if found is None:
            only = {} if key[1] is None else {"class": key[1]}
            classes, sure, open_ = set((key[1] or "").split()), 0, []
            for i, step in enumerate(self.steps):
                if any(n != "class" for n, _, _ in step.tests):
                    if (not step.tag or step.tag == tag) and step.classes <= classes:
                        open_.append((1 << i, step))
                elif step.fits(tag, only, classes):
                    sure |= 1 << i
            if len(self.fitting) >= _SEEN:
                self.fitting.clear()
            found = self.fitting[key] = sure, open_
        out, open_ = found
        for bit, step in open_:
            if all(n in attributes and (not op or _FITS[op](attributes[n], v)) for n, op, v in step.tests):
                out |= bit
        return out

    def bits(self, fits: int, above: int, parent: int) -> int:
        """Of the steps that an element ``fits``, those whose step before is among the bits above it."""
        out, bound = fits & self.free, fits & self.bound
        while bound:
            low = bound & -bound
            step = self.steps[low.bit_length() - 1]
            if (parent if step.child else above) >> step.before & 1:
                out |= low
            bound ^= low
        return out

    def known(self, raw: str) -> tuple[str, dict[str, str] | None, int, str] | None:
        """(tag, attributes, the steps it fits, the end tag that has to follow its raw text) of a plain tag, without attributes of an end tag; None of any other. Remembered."""
        found = _PLAIN.fullmatch(raw)
        if not found:
            return None
        if found[4]:
            out = found[4].lower(), None, 0, ""
        else:
            tag, attributes = found[1].lower(), {}
            if tag in _UNLIKE:
                return None
            for k, v in _ATTRIBUTE.findall(found[2]):
                attributes.setdefault(k.lower(), unescape(v) if "&" in v else v)
            out = tag, attributes, self.fits(tag, attributes), f"/{tag}" if tag in _RAW and not found[3] else ""
        if len(self.tags) >= _SEEN:
            self.tags.clear()
        self.tags[raw] = out
        return out

    def ended(self, bits: int) -> list[str]:
        """The selectors that end at an element of these bits."""
        found = self.named.get(bits)
        if found is None:
            if len(self.named) >= _SEEN:
                self.named.clear()
            found = self.named[bits] = [text for text, ends in self.ends.items() if bits & ends]
        return found


@dataclass(slots=True)
class Element:
    tag: str
    attributes: dict[str, str]
    parent: int
    bits: int
    above: int
    text_from: int
    end: int = 0
    text_to: int = 0
    children: int = 0


@dataclass
class Page:
    """A page's elements in order; an element's descendants follow it up to its ``end``."""

    elements: list[Element] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    hidden: set[int] = field(default_factory=set)
    found: dict[str, list[int]] = field(default_factory=dict)

    def all(self, selector: str, within: int | None = None) -> list[int]:
        """The elements that fit, below ``within`` if given."""
        at = self.found[selector]
        return at if within is None else at[bisect_left(at, within + 1) : bisect_left(at, self.elements[within].end)]

    def first(self, selector: str, within: int | None = None) -> int | None:
        at = self.found[selector]
        k = 0 if within is None else bisect_left(at, within + 1)
        return at[k] if k < len(at) and (within is None or at[k] < self.elements[within].end) else None

    def closest(self, selector: str, at: int) -> int | None:
        """The element itself or its nearest ancestor that fits."""
        fits = self.found[selector]
        while at >= 0:
            k = bisect_left(fits, at)
            if k < len(fits) and fits[k] == at:
                return at
            at = self.elements[at].parent
        return None

    def text(self, at: int) -> str:
        e = self.elements[at]
        return "".join(self.pieces[e.text_from : e.text_to]).strip()

    def read(self, at: int, names: tuple[str, ...]) -> str:
        """The first of these attributes that isn't empty; an empty name means the text."""
        return next((v for v in (self.elements[at].attributes.get(n, "") if n else self.text(at) for n in names) if v), "")

    def visible(self) -> str:
        """The text of all but scripts, styles and templates, white space squeezed."""
        return " ".join(" ".join(p for i, p in enumerate(self.pieces) if i not in self.hidden).split())


class _Reader(HTMLParser):
    def __init__(self, selectors: Selectors):
        self.selectors, self.page, self.open = selectors, Page(found={t: [] for t in selectors.ends}), []

    def _end(self, count: int) -> None:
        for i in self.open[len(self.open) - count :]:
            e = self.page.elements[i]
            e.end, e.text_to = len(self.page.elements), len(self.page.pieces)
        del self.open[len(self.open) - count :]

    def handle_starttag(self, tag, attrs):
        attributes = {}
        for k, v in attrs:
            attributes.setdefault(k, v or "")
        self.start(tag, attributes, self.selectors.fits(tag, attributes))

    def start(self, tag: str, attributes: dict[str, str], fits: int) -> None:
        page, open_, selectors = self.page, self.open, self.selectors
        elements = page.elements
        if tag in ENDED_BY:
            while open_ and elements[open_[-1]].tag in ENDED_BY[tag]:
                self._end(1)
        at, text_at = len(elements), len(page.pieces)
        if open_:
            parent = open_[-1]
            up = elements[parent]
            up.children += 1
            own = up.bits
            above = up.above | own
        else:
            parent, above, own = -1, 0, 0
        bits = selectors.bits(fits, above, own) if fits & selectors.bound else fits
        elements.append(Element(tag, attributes, parent, bits, above, text_at, at + 1, text_at))
        if bits:
            for text in selectors.ended(bits):
                page.found[text].append(at)
        if tag not in VOID:
            open_.append(at)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # as in HTML, a slash ends void elements only

    def handle_endtag(self, tag):
        open_, elements = self.open, self.page.elements
        if open_ and elements[open_[-1]].tag == tag:
            e = elements[open_.pop()]
            e.end, e.text_to = len(elements), len(self.page.pieces)
            return
        for k in range(len(open_) - 2, -1, -1):
            if elements[open_[k]].tag == tag:
                self._end(len(open_) - k)
                return

    def handle_data(self, data):
        if self.open and self.page.elements[self.open[-1]].tag in HIDDEN:
            self.page.hidden.add(len(self.page.pieces))
        self.page.pieces.append(data)

    def plain(self, html: str) -> bool:
        """Reads a page of plain markup, cut at its tags' first brackets; False, with the reader spoilt, where a page has any other."""
        seen, known, start, end, data = self.selectors.tags, self.selectors.known, self.start, self.handle_endtag, self.handle_data
        first, *parts = html.split("<")
        if first:
            data(unescape(first) if "&" in first else first)
        due = ""
        for part in parts:
            raw, closed, text = part.partition(">")
            if not closed or due and raw != due:
                return False
            found = seen.get(raw) or known(raw)
            if not found:
                return False
            tag, attributes, fits, due = found
            if attributes is None:
                end(tag)
            else:
                start(tag, attributes, fits)
            if text:
                data(unescape(text) if not due and "&" in text else text)
        return not due

    def any(self, html: str) -> None:
        """Reads a page of any markup by the standard parser, which plain pages don't set up."""
        super().__init__(convert_charrefs=True)
        self.feed(html)
        self.close()


def parsed(html: str | None, selectors: Selectors) -> Page:
    """``html`` with the elements that fit each selector; null is an empty page."""
    reader = _Reader(selectors)
    if not reader.plain(html or ""):
        reader = _Reader(selectors)
        reader.any(html or "")
    reader._end(len(reader.open))
    return reader.page
