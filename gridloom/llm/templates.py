"""A sandboxed template language, compiled to Python closures.

``{{ expression }}``, ``{% for x in xs %}``, ``{% if %} {% elif %} {% else %}``, ``{% set name = expression %}`` and
``{% generation %}`` around text a model should learn. Expressions know texts, whole numbers, true, false, none, names,
``a.b``, ``a['b']``, ``+ ~ == != < > <= >= in not and or`` and filters. A name or key is only ever looked up in given
mappings and lists: no attribute, method or function of Python can be reached. ``-`` at a tag's edge trims white space.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass


class TemplateError(ValueError):
    """The template can't be read, or uses something that isn't there."""


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    base: object
    key: object


@dataclass(frozen=True)
class Call:
    """A filter or operation on expressions."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Show:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    items: object
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


def text_of(value) -> str:
    if value is None:
        return ""
    return ("true" if value else "false") if isinstance(value, bool) else str(value)


def escape(value) -> str:
    r"""Control strings can't occur in the result: ``\`` becomes ``\\`` and ``<|`` becomes ``<\|``."""
    return text_of(value).replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(value) -> str:
    r"""As ``escape``, on one line: a line break becomes ``\n``."""
    return escape(value).replace("\n", "\\n")


def unescape(text: str) -> str:
    """What was escaped by either."""
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


OPERATIONS: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge,
    "+": operator.add, "~": lambda a, b: text_of(a) + text_of(b), "in": lambda a, b: a in b, "not": operator.not_,
    "trim": lambda x: text_of(x).strip(), "upper": lambda x: text_of(x).upper(), "lower": lambda x: text_of(x).lower(),
    "length": len, "default": lambda x, y: y if x is None else x, "escape": escape, "escape_line": escape_line,
}
FILTERS = {"trim", "upper", "lower", "length", "default", "escape", "escape_line"}

_TOKEN = re.compile(r"""\s*(?:(\d+)|("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>+~|.()\[\],]))""", re.S)
_TAG = re.compile(r"(\{\{-?|\{%-?)(.*?)(-?\}\}|-?%\})", re.S)
_CHARS = {"n": "\n", "t": "\t", "r": "\r"}


class Reader:
    """Reads one expression by precedence: or, and, not, comparison, sum, filter, item."""

    def __init__(self, text: str):
        self.text, self.at, self.tokens = text, 0, []
        at = 0
        while text[at:].strip():
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"Can't read {text[at:].strip()!r}")
            self.tokens.append((m.lastindex, m[m.lastindex]))
            at = m.end()

    def peek(self) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (0, None)
        return value if kind in (0, 3, 4) else None

    def take(self, *values: str) -> str | None:
        if self.peek() in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing in {self.text.strip()!r}")

    def whole(self):
        found = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} isn't expected in {self.text.strip()!r}")
        return found

    def either(self):
        left = self.both()
        while self.take("or"):
            left = folded(Call("or", (left, self.both())))
        return left

    def both(self):
        left = self.negated()
        while self.take("and"):
            left = folded(Call("and", (left, self.negated())))
        return left

    def negated(self):
        return folded(Call("not", (self.negated(),))) if self.take("not") else self.compared()

    def compared(self):
        left = self.added()
        while True:
            if found := self.take("==", "!=", "<", ">", "<=", ">=", "in"):
                left = folded(Call(found, (left, self.added())))
            elif self.peek() == "not" and self.at + 1 < len(self.tokens) and self.tokens[self.at + 1][1] == "in":
                self.at += 2
                left = folded(Call("not", (folded(Call("in", (left, self.added()))),)))
            else:
                return left

    def added(self):
        left = self.filtered()
        while found := self.take("+", "~"):
            left = folded(Call(found, (left, self.filtered())))
        return left

    def filtered(self):
        left = self.item()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"There is no filter {name!r}")
            args = []
            if self.take("("):
                while not self.take(")"):
                    args.append(self.either())
                    self.take(",")
            left = folded(Call(name, (left, *args)))
        return left

    def name(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (0, "the end")
        if kind != 3:
            raise TemplateError(f"A name is expected, not {value!r}")
        self.at += 1
        return value

    def item(self):
        left = self.plain()
        while True:
            if self.take("."):
                left = Item(left, Const(self.name()))
            elif self.take("["):
                left = Item(left, self.either())
                self.need("]")
            else:
                return left

    def plain(self):
        if self.at >= len(self.tokens):
            raise TemplateError(f"An expression is missing in {self.text.strip()!r}")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == 1:
            return Const(int(value))
        if kind == 2:
            return Const(re.sub(r"\\(.)", lambda m: _CHARS.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == 3:
            known = {"true": True, "false": False, "none": None}
            return Const(known[value]) if value in known else Name(value)
        if value == "(":
            inner = self.either()
            self.need(")")
            return inner
        raise TemplateError(f"{value!r} isn't expected in {self.text.strip()!r}")


def folded(call: Call):
    """A call whose operands are all known is its result."""
    if all(isinstance(a, Const) for a in call.args):
        values = [a.value for a in call.args]
        if call.name in ("and", "or"):
            return Const(values[0] and values[1] if call.name == "and" else values[0] or values[1])
        try:
            return Const(OPERATIONS[call.name](*values))
        except TypeError as e:
            raise TemplateError(f"{call.name} can't be used here: {e}") from e
    return call


def parse(source: str) -> tuple:
    """The template's syntax tree."""
    parts: list[tuple[str, str]] = []  # ("text" | "{{" | "{%", content)
    at, trim = 0, False
    for m in _TAG.finditer(source):
        text = source[at:m.start()]
        text = text.lstrip() if trim else text
        parts.append(("text", text.rstrip() if m[1].endswith("-") else text))
        if (m[1][:2] == "{{") != (m[3][-2:] == "}}"):
            raise TemplateError(f"{m[0]!r} isn't closed as it was opened")
        parts.append((m[1][:2], m[2].strip()))
        at, trim = m.end(), m[3].startswith("-")
    parts.append(("text", source[at:].lstrip() if trim else source[at:]))
    parts.reverse()

    def block(*ends: str) -> tuple[tuple, str]:
        """Statements up to a tag that begins with one of ``ends``; that tag."""
        body: list = []
        while parts:
            kind, content = parts.pop()
            if kind == "text":
                body.append(Text(content))
            elif kind == "{{":
                shown = Reader(content).whole()
                body.append(Text(text_of(shown.value)) if isinstance(shown, Const) else Show(shown))
            else:
                word, _, rest = content.partition(" ")
                if word in ends:
                    return joined(body), content
                if word == "for" and (m := re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)):
                    body.append(For(m[1], Reader(m[2]).whole(), block("endfor")[0]))
                elif word == "if":
                    branches, test = [], Reader(rest).whole()
                    while True:
                        inner, end = block("elif", "else", "endif")
                        branches.append((test, inner))
                        if end == "endif":
                            break
                        test = Const(True) if end == "else" else Reader(end[4:]).whole()
                    body += chosen(branches)
                elif word == "set" and (m := re.fullmatch(r"([A-Za-z_]\w*)\s*=\s*(.+)", rest.strip(), re.S)):
                    body.append(Set(m[1], Reader(m[2]).whole()))
                elif word == "generation":
                    body.append(Generation(block("endgeneration")[0]))
                else:
                    raise TemplateError(f"Can't read {{% {content} %}}")
        if ends:
            raise TemplateError(f"{{% {ends[-1]} %}} is missing")
        return joined(body), ""

    return block()[0]


def chosen(branches: list) -> tuple:
    """Without branches that can't be taken; the body itself where the first left is sure."""
    kept = []
    for test, body in branches:
        if isinstance(test, Const):
            if test.value:
                kept.append((test, body))
                break
        else:
            kept.append((test, body))
    if not kept:
        return ()
    return kept[0][1] if isinstance(kept[0][0], Const) else (If(tuple(kept)),)


def joined(body: list) -> tuple:
    """Neighbouring texts as one, empty ones left out."""
    out: list = []
    for x in body:
        if isinstance(x, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + x.text)
        elif x != Text(""):
            out.append(x)
    return tuple(out)


Scope = dict
Piece = tuple[str, bool]


def value_closure(node) -> Callable[[Scope], object]:
    if isinstance(node, Const):
        return lambda scope, value=node.value: value
    if isinstance(node, Name):
        return lambda scope, name=node.name: scope.get(name)
    if isinstance(node, Item):
        base, key = value_closure(node.base), value_closure(node.key)

        def item(scope):
            held, wanted = base(scope), key(scope)
            if isinstance(held, dict):
                return held.get(wanted)
            if isinstance(held, (list, tuple)) and isinstance(wanted, int):
                return held[wanted] if -len(held) <= wanted < len(held) else None
            return None

        return item
    args = [value_closure(a) for a in node.args]
    if node.name == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.name == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    run = OPERATIONS[node.name]
    if len(args) == 1:
        only = args[0]
        return lambda scope: run(only(scope))
    return lambda scope: run(*(a(scope) for a in args))


def body_closure(body: tuple, marked: bool = False) -> Callable[[Scope], Iterator[Piece]]:
    steps = [step_closure(x, marked) for x in body]

    def run(scope: Scope) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)

    return steps[0] if len(steps) == 1 else run


def step_closure(node, marked: bool) -> Callable[[Scope], Iterator[Piece]]:
    if isinstance(node, Text):
        pieces = ((node.text, marked),)
        return lambda scope: iter(pieces)
    if isinstance(node, Show):
        value = value_closure(node.value)
        return lambda scope: iter(((text_of(value(scope)), marked),))
    if isinstance(node, Generation):
        return body_closure(node.body, True)
    if isinstance(node, Set):
        value = value_closure(node.value)

        def put(scope: Scope) -> Iterator[Piece]:
            scope[node.name] = value(scope)
            return iter(())

        return put
    if isinstance(node, If):
        branches = [(value_closure(test), body_closure(body, marked)) for test, body in node.branches]

        def choose(scope: Scope) -> Iterator[Piece]:
            for test, body in branches:
                if test(scope):
                    return body(scope)
            return iter(())

        return choose
    items, body = value_closure(node.items), body_closure(node.body, marked)

    def loop(scope: Scope) -> Iterator[Piece]:
        """Looks one item ahead only, so that a long conversation is never held as a whole."""
        rest = iter(items(scope) or ())
        item, index = next(rest, rest), 0
        while item is not rest:
            following = next(rest, rest)
            inner = {**scope, node.name: item, "loop": {
                "index": index + 1, "index0": index, "first": not index, "last": following is rest}}
            yield from body(inner)
            item, index = following, index + 1

    return loop


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages (mappings, in order) to (text, is it to be learned) pieces."""
    run = body_closure(parse(source))
    return lambda messages, **more: run({**more, "messages": messages})
