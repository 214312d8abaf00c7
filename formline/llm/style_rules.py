"""Which elements style sheets hide: parsing, selectors and the cascade of ``display`` and ``visibility``.

Sheets are read as a browser of ``WIDTH`` by ``HEIGHT`` pixels shows them on a screen, with nothing hovered, focused
or visited. Rules count by importance, layer, inline style, specificity and order. Rules under conditions that cannot
be told from the page alone, and selectors that are not understood, hide nothing. Names of classes and ids match case by
case, on every page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

WIDTH, HEIGHT = 1280, 800
#: Blocks inside blocks beyond which a sheet is not read.
MAX_DEPTH = 32
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
_PIECE = re.compile(r"\"(?:[^\"\\]|\\.)*+\"|'(?:[^'\\]|\\.)*+'|\\.|[{};]|[^{};\"'\\]+|[\"'\\]", re.DOTALL)
_IDENT = r"(?:[\w-]|[^\x00-\x7f]|\\[0-9a-fA-F]{1,6}\s?|\\.)+"
_PART = re.compile(
    rf"(?P<tag>\*|{_IDENT})|#(?P<id>{_IDENT})|\.(?P<cls>{_IDENT})"
    rf"|\[\s*(?P<attr>{_IDENT})\s*(?:(?P<op>[~|^$*]?=)\s*(?:\"(?P<dq>[^\"]*)\"|'(?P<sq>[^']*)'|(?P<bare>[^\]\s]+))\s*(?P<ci>[iI])?\s*)?\]"
    rf"|::(?P<element>{_IDENT})|:(?P<pseudo>{_IDENT})(?P<args>\((?:[^()]|\([^()]*\))*\))?"
)
_ESCAPE = re.compile(r"\\(?:([0-9a-fA-F]{1,6})\s?|(.))", re.DOTALL)
_FEATURE = re.compile(r"\(\s*([a-z-]+)\s*(?::|(>=|<=|>|<|=))?\s*([^()]*?)\s*\)")
_LENGTH = re.compile(r"([\d.]+)\s*(px|em|rem)?$")


@dataclass
class Node:
    """What selectors see of an element."""

    tag: str
    attributes: dict[str, str]
    # the parent's children and the place among them, kept where a sheet asks for them
    family: list[Node] = field(default_factory=list)
    place: int = 0
    children: list[Node] = field(default_factory=list)

    @property
    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()


@dataclass
class Compound:
    tag: str = ""
    ids: list[str] = field(default_factory=list)
    classes: list[str] = field(default_factory=list)
    attributes: list[tuple[str, str, str, bool]] = field(default_factory=list)
    unlike: list[list[list[tuple[str, Compound]]]] = field(default_factory=list)
    alike: list[list[list[tuple[str, Compound]]]] = field(default_factory=list)
    root: bool = False
    first: bool = False

    def fits(self, node: Node, above: Sequence[Node], n: int) -> bool:
        if self.tag and self.tag != node.tag or self.root and node.tag != "html" or self.first and node.place:
            return False
        if any(node.attributes.get("id") != i for i in self.ids):
            return False
        if self.classes and not set(self.classes) <= set(node.classes):
            return False
        if not all(_attribute_fits(node.attributes, *a) for a in self.attributes):
            return False
        if any(matches(s, len(s), node, above, n) for group in self.unlike for s in group):
            return False
        return all(any(matches(s, len(s), node, above, n) for s in group) for group in self.alike)


def _attribute_fits(attributes: dict[str, str], name: str, op: str, wanted: str, any_case: bool) -> bool:
    if name not in attributes:
        return False
    value = attributes[name]
    if any_case:
        value, wanted = value.lower(), wanted.lower()
    if op == "":
        return True
    if op == "=":
        return value == wanted
    if op == "~=":
        return wanted in value.split()
    if op == "|=":
        return value == wanted or value.startswith(wanted + "-")
    if not wanted:
        return False
    return value.startswith(wanted) if op == "^=" else value.endswith(wanted) if op == "$=" else wanted in value


#: A selector is a list of (combinator to the left, compound) from left to right.
Selector = list[tuple[str, Compound]]


def matches(selector: Selector, size: int, node: Node, above: Sequence[Node], n: int) -> bool:
    """Whether the first ``size`` parts of a selector pick ``node``, whose ancestors are the first ``n`` of ``above``."""
    combinator, compound = selector[size - 1]
    if not compound.fits(node, above, n):
        return False
    if size == 1:
        return True
    if combinator == ">":
        return n > 0 and matches(selector, size - 1, above[n - 1], above, n - 1)
    if combinator == " ":
        return any(matches(selector, size - 1, above[i], above, i) for i in range(n - 1, -1, -1))
    youngest = 0 if combinator == "~" else max(node.place - 1, 0)
    return any(matches(selector, size - 1, node.family[i], above, n) for i in range(node.place - 1, youngest - 1, -1))


def unescaped(name: str) -> str:
    def char(m: re.Match) -> str:
        if not m[1]:
            return m[2]
        code = int(m[1], 16)
        return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"

    return _ESCAPE.sub(char, name) if "\\" in name else name


def _split(text: str, marks: str) -> list[str]:
    """``text`` cut at any of ``marks`` outside of brackets and quotes."""
    out, depth, start, quote = [], 0, 0, ""
    at = 0
    while at < len(text):
        c = text[at]
        if c == "\\":
            at += 2
            continue
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        elif c in marks and depth <= 0:
            out.append(text[start:at])
            start = at + 1
        at += 1
    out.append(text[start:])
    return out


def parse_selector(text: str) -> tuple[Selector, tuple[int, int, int]] | None:
    """A selector and its specificity; None if it is not understood or picks nothing on a resting page."""
    text = re.sub(r"\s*([>+~])\s*(?![^\[]*\])", r" \1 ", text.strip())
    words = [w for w in re.split(r"\s+(?![^\[(]*[\])])", text) if w]
    selector: Selector = []
    weight = [0, 0, 0]
    combinator = " "
    for word in words:
        if word in (">", "+", "~"):
            combinator = word
            continue
        compound = _compound(word, weight)
        if compound is None:
            return None
        selector.append((combinator, compound))
        combinator = " "
    return (selector, tuple(weight)) if selector else None


def _compound(word: str, weight: list[int]) -> Compound | None:
    out, at = Compound(), 0
    while at < len(word):
        m = _PART.match(word, at)
        if m is None or m["tag"] and at:
            return None
        at = m.end()
        if m["tag"]:
            if m["tag"] != "*":
                out.tag = unescaped(m["tag"]).lower()
                weight[2] += 1
        elif m["id"]:
            out.ids.append(unescaped(m["id"]))
            weight[0] += 1
        elif m["cls"]:
            out.classes.append(unescaped(m["cls"]))
            weight[1] += 1
        elif m["attr"]:
            value = next((m[g] for g in ("dq", "sq", "bare") if m[g] is not None), "")
            out.attributes.append((unescaped(m["attr"]).lower(), m["op"] or "", unescaped(value), bool(m["ci"])))
            weight[1] += 1
        elif m["element"]:
            return None  # no element, only a part of one
        elif not _pseudo(m["pseudo"].lower(), m["args"], out, weight):
            return None
    return out


def _pseudo(name: str, args: str | None, out: Compound, weight: list[int]) -> bool:
    if args is None:
        if name not in ("root", "first-child", "link", "any-link", "enabled"):
            return False
        out.root |= name == "root"
        out.first |= name == "first-child"
        if name in ("link", "any-link"):
            out.attributes.append(("href", "", "", False))
        weight[1] += 1
        return True
    if name not in ("not", "is", "where", "matches"):
        return False
    parsed = [parse_selector(s) for s in _split(args[1:-1], ",")]
    if name == "not" and None in parsed:
        # what is not understood may pick anything, so that its opposite may pick nothing
        return False
    understood = [p for p in parsed if p is not None]
    (out.unlike if name == "not" else out.alike).append([s for s, _ in understood])
    if name != "where" and understood:
        for i, w in enumerate(max(w for _, w in understood)):
            weight[i] += w
    return True


def on_screen(query: str) -> bool:
    """Whether a media query list holds on the screen that pages are read on."""
    return any(_query_holds(q) for q in _split(query.lower(), ",")) if query.strip() else True


def _query_holds(query: str) -> bool:
    query = query.strip()
    negated = query.startswith("not ")
    query = re.sub(r"^(?:not|only)\s+", "", query)
    holds = True
    for part in re.split(r"\s+and\s+", query):
        part = part.strip()
        if part.startswith("("):
            m = _FEATURE.fullmatch(part)
            told = _feature_holds(m[1], m[2], m[3]) if m else None
            if told is None:
                return False  # whatever the rest says, it cannot be told
            holds &= told
        else:
            holds &= part in ("all", "screen")
    return holds != negated


def _feature_holds(name: str, op: str | None, value: str) -> bool | None:
    fixed = {
        "orientation": "landscape", "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine",
        "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "scripting": "enabled", "update": "fast",
        "prefers-contrast": "no-preference", "display-mode": "browser", "forced-colors": "none",
    }
    if name in fixed:
        return value == fixed[name] if value else fixed[name] not in ("none", "no-preference")
    least, most = name.startswith("min-"), name.startswith("max-")
    size = {"width": WIDTH, "height": HEIGHT, "device-width": WIDTH, "device-height": HEIGHT}.get(re.sub("^m(?:in|ax)-", "", name))
    if size is None:
        return None
    if not value:
        return True
    m = _LENGTH.match(value)
    if m is None:
        return None
    length = float(m[1]) * (16 if m[2] in ("em", "rem") else 1)
    if op in (">", ">=", "<", "<="):
        return {">": size > length, ">=": size >= length, "<": size < length, "<=": size <= length}[op]
    return size >= length if least else size <= length if most else size == length


def declarations(body: str) -> Iterator[tuple[str, str, bool]]:
    """(property, value, important) of the properties that can hide."""
    for part in _split(body, ";"):
        name, colon, value = part.partition(":")
        name = name.strip().lower()
        if not colon or name not in ("display", "visibility"):
            continue
        value = value.strip().lower()
        important = re.search(r"\s*!\s*important$", value)
        value = value[: important.start()] if important else value
        if value:
            yield name, value, important is not None


@dataclass
class Rule:
    selector: Selector
    weight: tuple[int, int, int]
    layer: float
    order: int
    told: list[tuple[str, str, bool]]


class Sheets:
    """The rules of a page's sheets that can hide something, found by the last compound of their selectors."""

    def __init__(self) -> None:
        self.by_key: dict[str, list[Rule]] = {}
        self.layers: dict[str, int] = {}
        self.siblings = False
        self.n = 0

    def add(self, css: str, media: str = "") -> None:
        if on_screen(media):
            pieces = _PIECE.findall(_COMMENT.sub(" ", css).replace("<!--", " ").replace("-->", " "))
            self._block(pieces, 0, float("inf"), "", 0)

    def _block(self, pieces: list[str], at: int, layer: float, prefix: str, depth: int) -> int:
        """Reads rules from ``at`` up to the end of their block; returns the place behind it."""
        prelude: list[str] = []
        while at < len(pieces):
            piece = pieces[at]
            at += 1
            if piece == "}":
                return at
            if piece == ";":
                self._statement("".join(prelude).strip(), prefix)
                prelude = []
            elif piece == "{":
                head = "".join(prelude).strip()
                prelude = []
                at = self._rule(head, pieces, at, layer, prefix, depth)
            else:
                prelude.append(piece)
        return at

    def _statement(self, text: str, prefix: str) -> None:
        if text.lower().startswith("@layer"):
            for name in text[6:].split(","):
                self._layer(prefix + name.strip())

    def _layer(self, name: str) -> int:
        return self.layers.setdefault(name, len(self.layers))

    def _rule(self, head: str, pieces: list[str], at: int, layer: float, prefix: str, depth: int) -> int:
        if head.startswith("@"):
            name, _, rest = head[1:].partition(" ")
            name = name.lower().split("(")[0]
            rest = head[1 + len(name) :].strip()
            if depth < MAX_DEPTH:
                if name == "media" and on_screen(rest):
                    return self._block(pieces, at, layer, prefix, depth + 1)
                if name == "supports" and not rest.lower().startswith("not"):
                    return self._block(pieces, at, layer, prefix, depth + 1)
                if name == "layer":
                    inner = prefix + (rest or f"\0{len(self.layers)}")
                    return self._block(pieces, at, self._layer(inner), inner + ".", depth + 1)
            return _skipped(pieces, at)
        start = at
        at = _skipped(pieces, at)
        own, depth_now = [], 0
        for piece in pieces[start : at - 1 if at <= len(pieces) and pieces[at - 1 : at] == ["}"] else at]:
            depth_now += (piece == "{") - (piece == "}")
            if depth_now == 0 and piece != "}":
                own.append(piece)  # rules nested in this one are left out
            elif piece == "{":
                while own and own[-1] != ";":
                    own.pop()
        told = list(declarations("".join(own)))
        if told:
            for text in _split(head, ","):
                parsed = parse_selector(text)
                if parsed is not None:
                    self._keep(Rule(*parsed, layer, self.n, told))
                    self.n += 1
        return at

    def _keep(self, rule: Rule) -> None:
        last = rule.selector[-1][1]
        key = "#" + last.ids[0] if last.ids else "." + last.classes[0] if last.classes else last.tag
        self.by_key.setdefault(key, []).append(rule)
        self.siblings |= any(c in "+~" for c, _ in rule.selector) or any(p.first for _, p in rule.selector)
        nested = [s for _, p in rule.selector for group in (*p.unlike, *p.alike) for s in group]
        self.siblings |= any(c in "+~" or p.first for s in nested for c, p in s)

    def told(self, node: Node, above: Sequence[Node], inline: str) -> dict[str, str]:
        """What holds for ``node``: at most a ``display`` and a ``visibility``."""
        best: dict[str, tuple] = {}
        if self.by_key:
            keys = ["", node.tag, *("." + c for c in node.classes)]
            if "id" in node.attributes:
                keys.append("#" + node.attributes["id"])
            for key in keys:
                for rule in self.by_key.get(key, ()):
                    if matches(rule.selector, len(rule.selector), node, above, len(above)):
                        for name, value, important in rule.told:
                            # among important rules the earlier layers win
                            layer = -rule.layer if important else rule.layer
                            rank = (important, False, layer, rule.weight, rule.order)
                            if name not in best or rank >= best[name][0]:
                                best[name] = (rank, value)
        for name, value, important in declarations(inline) if inline else ():
            rank = (important, True, 0.0, (0, 0, 0), 0)
            if name not in best or rank >= best[name][0]:
                best[name] = (rank, value)
        return {name: value for name, (_, value) in best.items()}


def _skipped(pieces: list[str], at: int) -> int:
    """The place behind the block that ``at`` is in."""
    depth = 1
    while at < len(pieces) and depth:
        depth += (pieces[at] == "{") - (pieces[at] == "}")
        at += 1
    return at
