"""A compiler for a small sandboxed template language.

    text {{ expression }} {% for m in messages %} .. {% endfor %} {% if a %} .. {% elif b %} .. {% else %} .. {% endif %}
    {% set x = expression %} {% generation %} .. {% endgeneration %} {# comment #}     (- inside a tag's end trims white space)

Expressions: strings, integers, true / false / none, names, ``a.b`` and ``a['b']`` on mappings, ``== != < > <= >= in``,
``and or not``, ``+`` and ``~``, ``x if c else y``, and filters such as ``x | trim``.  Source text becomes a syntax tree, constant
parts are folded, and the tree becomes nested Python closures.  Templates cannot call, import or reach Python attributes:
only mappings are looked into, and only listed filters exist.  Loops take any iterable and read one element ahead, so a
conversation of any length streams through.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

BEGIN, END = object(), object()  # markers of a generation block among the pieces


class TemplateError(ValueError):
    pass


# --- syntax tree ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: Any
    key: Any


@dataclass(frozen=True)
class Unary:
    op: str
    x: Any


@dataclass(frozen=True)
class Binary:
    op: str
    a: Any
    b: Any


@dataclass(frozen=True)
class Choice:
    test: Any
    yes: Any
    no: Any


@dataclass(frozen=True)
class Filter:
    name: str
    x: Any


@dataclass(frozen=True)
class Output:
    x: Any


@dataclass(frozen=True)
class Set:
    name: str
    x: Any


@dataclass(frozen=True)
class If:
    test: Any
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


OPERATORS: dict[str, Callable] = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le,
                                  ">=": operator.ge, "in": lambda a, b: a in b, "+": operator.add,
                                  "~": lambda a, b: _show(a) + _show(b)}
FILTERS: dict[str, Callable] = {"trim": lambda x: x.strip(), "upper": lambda x: x.upper(), "lower": lambda x: x.lower(),
                                "length": lambda x: len(x), "string": lambda x: _show(x)}


def _show(x: Any) -> str:
    return x if isinstance(x, str) else "" if x is None else str(x).lower() if isinstance(x, bool) else str(x)


# --- reading -------------------------------------------------------------------------------

_PIECES = re.compile(r"\{\{-?|\{%-?|\{#")
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"""
                    r"""|(?P<op>==|!=|<=|>=|[<>+~|.()\[\]=]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _lex(source: str) -> list[tuple[str, Any]]:
    out, at = [], 0
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            if not source[at:].strip():
                break
            raise TemplateError(f"cannot read {source[at:at + 20]!r}")
        kind, text = m.lastgroup, m[m.lastgroup]
        if kind == "str":
            out.append(("const", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), text[1:-1], flags=re.S)))
        elif kind == "int":
            out.append(("const", int(text)))
        elif text.lower() in ("true", "false", "none"):
            out.append(("const", {"true": True, "false": False, "none": None}[text.lower()]))
        elif text in ("and", "or", "not", "in", "if", "else"):
            out.append(("op", text))
        else:
            out.append((kind, text))
        at = m.end()
    return [*out, ("end", "")]


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.tokens, self.at = _lex(source), 0

    def peek(self, *ops: str) -> bool:
        return self.tokens[self.at][0] == "op" and self.tokens[self.at][1] in ops

    def take(self, kind: str, *ops: str) -> Any:
        got, value = self.tokens[self.at]
        if got != kind or ops and value not in ops:
            raise TemplateError(f"expected {ops or kind}, found {value!r}")
        self.at += 1
        return value

    def whole(self) -> Any:
        x = self.choice()
        self.take("end")
        return x

    def choice(self) -> Any:
        x = self.binary(0)
        if self.peek("if"):
            self.take("op")
            test = self.binary(0)
            self.take("op", "else")
            return Choice(test, x, self.choice())
        return x

    LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", ">", "<=", ">=", "in"), ("+", "~"))

    def binary(self, level: int) -> Any:
        if level == len(self.LEVELS):
            return self.filtered()
        ops = self.LEVELS[level]
        if ops == ("not",):
            if self.peek("not"):
                self.take("op")
                return Unary("not", self.binary(level))
            return self.binary(level + 1)
        x = self.binary(level + 1)
        while self.peek(*ops):
            x = Binary(self.take("op"), x, self.binary(level + 1))
        return x

    def filtered(self) -> Any:
        x = self.primary()
        while self.peek("|"):
            self.take("op")
            x = Filter(self.take("name"), x)
        return x

    def primary(self) -> Any:
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "const":
            x: Any = Const(value)
        elif kind == "name":
            x = Name(value)
        elif (kind, value) == ("op", "("):
            x = self.choice()
            self.take("op", ")")
        else:
            raise TemplateError(f"unexpected {value!r}")
        while self.peek(".", "["):
            if self.take("op") == ".":
                x = Item(x, Const(self.take("name")))
            else:
                x = Item(x, self.choice())
                self.take("op", "]")
        return x


def parse(source: str) -> tuple:
    """Syntax tree of a template."""
    tags: list[tuple[str, str]] = []
    at, trim = 0, False
    while True:
        m = _PIECES.search(source, at)
        text = source[at:m.start() if m else len(source)]
        if trim:
            text = text.lstrip()
        if m and m[0].endswith("-"):
            text = text.rstrip()
        if text:
            tags.append(("text", text))
        if not m:
            break
        kind = m[0][:2]
        close = {"{{": "}}", "{%": "%}", "{#": "#}"}[kind]
        end = _tag_end(source, m.end(), close)
        body = source[m.end():end]
        trim = kind != "{#" and body.endswith("-")
        if kind != "{#":
            tags.append((kind, body.removesuffix("-").strip()))
        at = end + 2
    body, rest = _body(tags, 0, ())
    return body


def _tag_end(source: str, at: int, close: str) -> int:
    quote = ""
    while at < len(source):
        c = source[at]
        if quote:
            at += c == "\\"
            quote = "" if c == quote else quote
        elif c in "'\"" and close != "#}":
            quote = c
        elif source.startswith(close, at):
            return at
        at += 1
    raise TemplateError(f"a tag is not closed by {close}")


def _body(tags: list[tuple[str, str]], at: int, ends: tuple[str, ...]) -> tuple[tuple, int]:
    out: list[Any] = []
    while at < len(tags):
        kind, text = tags[at]
        at += 1
        if kind == "text":
            out.append(Output(Const(text)))
            continue
        if kind == "{{":
            out.append(Output(_Expression(text).whole()))
            continue
        word, _, rest = text.partition(" ")
        if word in ends:
            return tuple(out), at - 1
        if word == "set":
            name, _, value = rest.partition("=")
            if not name.strip().isidentifier():
                raise TemplateError(f"cannot set {name!r}")
            out.append(Set(name.strip(), _Expression(value).whole()))
        elif word == "generation":
            inner, at = _body(tags, at, ("endgeneration",))
            out.append(Generation(inner))
            at += 1
        elif word == "for":
            m = re.fullmatch(r"(\w+)\s+in\s+(.+)", rest.strip(), re.S)
            if not m:
                raise TemplateError(f"cannot read for {rest!r}")
            inner, at = _body(tags, at, ("endfor",))
            out.append(For(m[1], _Expression(m[2]).whole(), inner))
            at += 1
        elif word == "if":
            node, at = _if(tags, at, rest)
            out.append(node)
        else:
            raise TemplateError(f"unknown or misplaced tag {text!r}")
    if ends:
        raise TemplateError(f"missing {ends[-1]}")
    return tuple(out), at


def _if(tags: list[tuple[str, str]], at: int, test: str) -> tuple[If, int]:
    yes, at = _body(tags, at, ("elif", "else", "endif"))
    word, _, rest = tags[at][1].partition(" ")
    if word == "elif":
        inner, at = _if(tags, at + 1, rest)
        return If(_Expression(test).whole(), yes, (inner,)), at
    no: tuple = ()
    if word == "else":
        no, at = _body(tags, at + 1, ("endif",))
    return If(_Expression(test).whole(), yes, no), at + 1


# --- folding -------------------------------------------------------------------------------

def fold(x: Any, filters: Mapping[str, Callable]) -> Any:
    """The expression with constant parts computed."""
    if isinstance(x, Unary):
        a = fold(x.x, filters)
        return Const(not a.value) if isinstance(a, Const) else Unary(x.op, a)
    if isinstance(x, Binary):
        a, b = fold(x.a, filters), fold(x.b, filters)
        if x.op in ("and", "or") and isinstance(a, Const):
            return b if bool(a.value) == (x.op == "and") else a
        if isinstance(a, Const) and isinstance(b, Const) and x.op in OPERATORS:
            try:
                return Const(OPERATORS[x.op](a.value, b.value))
            except TypeError as e:
                raise TemplateError(str(e)) from e
        return Binary(x.op, a, b)
    if isinstance(x, Choice):
        test = fold(x.test, filters)
        if isinstance(test, Const):
            return fold(x.yes if test.value else x.no, filters)
        return Choice(test, fold(x.yes, filters), fold(x.no, filters))
    if isinstance(x, Filter):
        if x.name not in filters:
            raise TemplateError(f"unknown filter {x.name}")
        a = fold(x.x, filters)
        return Const(filters[x.name](a.value)) if isinstance(a, Const) else Filter(x.name, a)
    if isinstance(x, Item):
        return Item(fold(x.of, filters), fold(x.key, filters))
    return x


def fold_body(body: tuple, filters: Mapping[str, Callable]) -> tuple:
    """The statements with constant expressions, tests and neighbouring texts folded."""
    out: list[Any] = []
    for node in body:
        if isinstance(node, If):
            test = fold(node.test, filters)
            if isinstance(test, Const):
                new: Iterable = fold_body(node.yes if test.value else node.no, filters)
            else:
                new = (If(test, fold_body(node.yes, filters), fold_body(node.no, filters)),)
        elif isinstance(node, For):
            new = (For(node.name, fold(node.over, filters), fold_body(node.body, filters)),)
        elif isinstance(node, Generation):
            new = (Generation(fold_body(node.body, filters)),)
        elif isinstance(node, Set):
            new = (Set(node.name, fold(node.x, filters)),)
        else:
            x = fold(node.x, filters)
            new = (Output(Const(_show(x.value)) if isinstance(x, Const) else x),)
        for n in new:
            last = out[-1] if out else None
            if isinstance(n, Output) and isinstance(n.x, Const):
                if not n.x.value:
                    continue
                if isinstance(last, Output) and isinstance(last.x, Const):
                    out[-1] = Output(Const(last.x.value + n.x.value))
                    continue
            out.append(n)
    return tuple(out)


# --- closures ------------------------------------------------------------------------------

Env = dict[str, Any]


def _value(x: Any, filters: Mapping[str, Callable]) -> Callable[[Env], Any]:
    if isinstance(x, Const):
        return lambda env, v=x.value: v
    if isinstance(x, Name):
        return lambda env, n=x.name: env.get(n)
    if isinstance(x, Item):
        of, key = _value(x.of, filters), _value(x.key, filters)

        def item(env: Env) -> Any:
            holder = of(env)
            if not isinstance(holder, Mapping):
                raise TemplateError("only mappings have items")
            return holder.get(key(env))

        return item
    if isinstance(x, Unary):
        a = _value(x.x, filters)
        return lambda env: not a(env)
    if isinstance(x, Binary):
        a, b = _value(x.a, filters), _value(x.b, filters)
        if x.op == "and":
            return lambda env: a(env) and b(env)
        if x.op == "or":
            return lambda env: a(env) or b(env)
        return lambda env, op=OPERATORS[x.op]: op(a(env), b(env))
    if isinstance(x, Choice):
        test, yes, no = (_value(y, filters) for y in (x.test, x.yes, x.no))
        return lambda env: yes(env) if test(env) else no(env)
    if isinstance(x, Filter):
        a = _value(x.x, filters)
        return lambda env, f=filters[x.name]: f(a(env))
    raise TemplateError(f"cannot compile {x!r}")


Render = Callable[[Env], Iterator[Any]]


def _statements(body: tuple, filters: Mapping[str, Callable]) -> Render:
    parts = [_statement(node, filters) for node in body]
    if len(parts) == 1:
        return parts[0]

    def run(env: Env) -> Iterator[Any]:
        for part in parts:
            yield from part(env)

    return run


def _statement(node: Any, filters: Mapping[str, Callable]) -> Render:
    if isinstance(node, Output):
        if isinstance(node.x, Const):
            return lambda env, text=node.x.value: iter((text,))
        value = _value(node.x, filters)
        return lambda env: iter((_show(value(env)),))
    if isinstance(node, Set):
        value = _value(node.x, filters)

        def assign(env: Env) -> Iterator[Any]:
            env[node.name] = value(env)
            return iter(())

        return assign
    if isinstance(node, If):
        test, yes, no = _value(node.test, filters), _statements(node.yes, filters), _statements(node.no, filters)
        return lambda env: yes(env) if test(env) else no(env)
    if isinstance(node, Generation):
        inner = _statements(node.body, filters)

        def marked(env: Env) -> Iterator[Any]:
            yield BEGIN
            yield from inner(env)
            yield END

        return marked
    over, inner = _value(node.over, filters), _statements(node.body, filters)

    def loop(env: Env) -> Iterator[Any]:
        elements = iter(over(env) or ())
        sentinel = object()
        current, n = next(elements, sentinel), 0
        scope = dict(env)
        while current is not sentinel:
            following = next(elements, sentinel)
            scope[node.name] = current
            scope["loop"] = {"index": n + 1, "index0": n, "first": n == 0, "last": following is sentinel}
            yield from inner(scope)
            current, n = following, n + 1

    return loop


class Template:
    """A compiled template.  ``render(**variables)`` yields strings, and BEGIN / END around generation blocks."""

    def __init__(self, source: str, filters: Mapping[str, Callable] | None = None):
        self.source, self.filters = source, {**FILTERS, **(filters or {})}
        self.tree = fold_body(parse(source), self.filters)
        self._run = _statements(self.tree, self.filters)

    def render(self, **variables: Any) -> Iterator[Any]:
        return self._run(dict(variables))
