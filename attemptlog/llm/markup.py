"""One page as elements and blocks of text: what the HTML operator reads of a page.

Reading is a single pass. A tag ends at the first ``>`` outside a quoted value, comments,
scripts and styles are skipped, and what is left open is closed by the next tag that cannot
stand inside it, as browsers do.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from dataclasses import dataclass, field

# Element names by what they do to the text around them, and words of class,
# id and role that name parts of a page that are not its article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr br script style button input select svg "
    "canvas audio video object map area embed picture source track noscript template slot".split()
)
ASIDE = frozenset(
    "head nav footer aside form fieldset script style noscript iframe noembed noframes object svg canvas template "
    "button select textarea dialog menu audio video title".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs footer contentinfo sidebar complementary notice notices cookie "
    "cookies consent gdpr alert popup modal overlay dialog comment comments commentlist disqus respond replies "
    "newsletter subscribe signup login search share sharing social related recommended pagination pager".split()
)
#: Parts that are not the article's only where they stand outside it.
OUTSIDE = frozenset({"header"})
OUTSIDE_WORDS = frozenset({"header", "masthead", "topbar"})
ARTICLE, MAIN = "article", "main"
#: An element that one of these closes when it opens inside it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_MARK = re.compile(
    r"<!--(?:-?>|.*?--!?>|.*)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"
    r"|<[!?/][^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAMES = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_MARKED = re.compile(r"class|id|role", re.I)
_DIGITS = re.compile(r"[0-9]+")
_ENDED = re.compile(r"^<!--?-?>$|--!?>$")
_UNFINISHED = re.compile(r"<[A-Za-z/!?]")


def _digest(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"\0".join(parts), digest_size=8).digest(), "little", signed=True)


@dataclass(slots=True)
class Element:
    """An open element; ``token`` stands for its path of names, classes and ids, ``block`` for the
    nearest path that is not inline."""

    name: str
    token: int
    block: int
    aside: bool
    article: str


@dataclass(slots=True)
class Path:
    """All elements of one path: how many, where the first and the last stands, text inside."""

    parent: int
    depth: int
    aside: bool
    article: str
    first: int
    count: int = 0
    last: int = 0
    chars: int = 0


@dataclass(slots=True)
class Block:
    """A block's text outside of side parts, and the path it stands in."""

    text: str
    within: int
    article: str
    order: int

    @property
    def token(self) -> int:
        return _digest(b"text", str(self.within).encode(), self.text.encode("utf-8", "replace"))


@dataclass
class Page:
    """Paths in the order in which they first open, so that a parent comes before its children."""

    paths: dict[int, Path] = field(default_factory=dict)
    blocks: list[Block] = field(default_factory=list)

    def inside(self, tokens: set[int]) -> set[int]:
        """Paths that are, or stand in, one of ``tokens`` that is no side part."""
        found: set[int] = set()
        for token, path in self.paths.items():
            if path.parent in found or token in tokens and not path.aside:
                found.add(token)
        return found


class Reader:
    """Reads pages; remembers the tokens of paths, which pages share."""

    REMEMBERED = 1 << 16

    def __init__(self) -> None:
        self.tokens: dict[tuple[int, str], int] = {}
        self.kinds: dict[tuple[str, str], tuple[str, bool, bool, str]] = {}

    def _kind(self, name: str, rest: str) -> tuple[str, bool, bool, str]:
        """Signature of a tag, whether it is a side part, one outside articles only, and its article kind."""
        rest = rest if _MARKED.search(rest) else ""
        got = self.kinds.get((name, rest))
        if got is None:
            values = {}
            for key, *value in _ATTRIBUTE.findall(rest):
                values.setdefault(key.lower(), next((v for v in value if v), ""))
            marks = " ".join(values.get(k, "") for k in ("class", "id", "role"))
            words = {w.lower() for w in _NAMES.findall(marks)} | set(re.split("[^a-z0-9]+", marks.lower()))
            article = name if name in (ARTICLE, MAIN) else values.get("role", "").lower()
            article = article if article in (ARTICLE, MAIN) else ""
            side = name in ASIDE or bool(words & ASIDE_WORDS) and name not in ("html", "body")
            outside = name in OUTSIDE or bool(words & OUTSIDE_WORDS) and name not in ("html", "body")
            shape = sorted(_DIGITS.sub("0", w) for w in values.get("class", "").split())
            named = ".".join([name, *shape]) + "#" + _DIGITS.sub("0", values.get("id", "")) + "@" + values.get("role", "")
            got = (named, side, outside, article)
            if len(self.kinds) >= self.REMEMBERED:
                self.kinds.clear()
            self.kinds[name, rest] = got
        return got

    def _token(self, parent: int, named: str) -> int:
        got = self.tokens.get((parent, named))
        if got is None:
            got = _digest(str(parent).encode(), named.encode("utf-8", "replace"))
            if len(self.tokens) >= self.REMEMBERED:
                self.tokens.clear()
            self.tokens[parent, named] = got
        return got

    def __call__(self, text: str) -> Page:
        return _Reading(self, text).page


class _Reading:
    def __init__(self, reader: Reader, text: str) -> None:
        self.reader, self.page = reader, Page()
        self.stack: list[Element] = []
        self.open: dict[str, int] = {}
        self.pieces: list[str] = []
        self.started: tuple[int, str] | None = None
        self.order = self.linked = 0
        self._read(text)
        for path in reversed(self.page.paths.values()):
            if path.parent:
                self.page.paths[path.parent].chars += path.chars

    def _read(self, text: str) -> None:
        end, at = text.rfind(">") + 1, 0
        while at < end:
            mark = _MARK.search(text, at, end)
            if not mark:
                break
            if mark.start() > at:
                self._text(text[at : mark.start()])
            at = mark.end()
            slash, name, rest = mark.groups()
            if name is None:
                if at == end and mark[0].startswith("<!--") and not _ENDED.search(mark[0]):
                    at = len(text)
                continue
            name = name.lower()
            if slash:
                self._close(name)
                continue
            self._start(name, rest)
            if name in RAW:
                stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(text, at)
                if stop or name in ("script", "style"):
                    at = stop.start() if stop else len(text)
        tail = text[at:]
        cut = _UNFINISHED.search(tail)
        self._text(tail[: cut.start()] if cut else tail)
        self._flush()

    def _text(self, raw: str) -> None:
        top = self.stack[-1] if self.stack else None
        if top is not None and top.aside:
            return
        if self.started is None:
            if raw.isspace():
                return
            self.started = (top.block, top.article) if top else (0, "")
        self.pieces.append(raw)
        if self.open.get("a"):
            self.linked += len(raw)

    def _flush(self) -> None:
        if self.started is not None:
            text = " ".join(entities.unescape("".join(self.pieces)).split())
            if text:
                self.order += 1
                self.page.blocks.append(Block(text, *self.started, self.order))
                if self.started[0]:
                    self.page.paths[self.started[0]].chars += max(0, len(text) - self.linked)
        self.pieces, self.started, self.linked = [], None, 0

    def _start(self, name: str, rest: str) -> None:
        if name == "br":
            if self.started is not None:
                self.pieces.append(" ")
            return
        if name not in INLINE:
            self._flush()
            if self.open.get("p"):
                self._close("p")
        if name in CLOSES:
            closed, within = CLOSES[name]
            for element in reversed(self.stack) if any(map(self.open.get, closed)) else ():
                if element.name in within:
                    break
                if element.name in closed:
                    self._close(element.name)
                    break
        named, side, outside, article = self.reader._kind(name, rest)
        parent = self.stack[-1] if self.stack else None
        token = self.reader._token(parent.token if parent else 0, named)
        inside = parent is not None and bool(parent.article)
        aside = parent is not None and parent.aside or side or outside and not inside
        self.order += 1
        path = self.page.paths.get(token)
        if path is None:
            path = Path(parent.token if parent else 0, len(self.stack), aside, article, self.order)
            self.page.paths[token] = path
        path.count += 1
        path.last = self.order
        if name not in VOID:
            held = parent.article if parent and parent.article == ARTICLE else article or (parent.article if parent else "")
            block = token if name not in INLINE else parent.block if parent else 0
            self.stack.append(Element(name, token, block, aside, held))
            self.open[name] = self.open.get(name, 0) + 1

    def _close(self, name: str) -> None:
        if name not in INLINE:
            self._flush()
        if not self.open.get(name):
            return
        if name in INLINE:
            # An inline element that a block inside it has outlived ends with that block's parent.
            for element in reversed(self.stack):
                if element.name == name:
                    break
                if element.name not in INLINE:
                    return
        while self.stack:
            last = self.stack.pop().name
            self.open[last] -= 1
            if last == name:
                return
