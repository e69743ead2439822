"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}                      its value as text, null as nothing
    {% if e %} {% elif e %} {% else %} {% endif %}
    {% for name in e %} {% endfor %}      any iterable, read once and not kept
    {% set name = e %}
    {% generation %} {% endgeneration %}  marks what a model is to learn

Expressions have texts, whole numbers, true, false, none, names, .fields of mappings, + == != <
<= > >=, not, and, or, parentheses and |filters. There is no call, no index and no attribute
of a Python object, so a template reaches only the values it is given.

Source is cut into tokens, parsed into a tree of tuples, folded, and each node becomes a
closure. Folding replaces operations on constants by their value, drops branches that never
run and joins neighbouring texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

Emit = Callable[[str, bool], None]

FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda v: _text(v).strip(),
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "length": lambda v: len(v) if v is not None else 0,
    "text": lambda v: _text(v),
}

_TAG = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
_TOKEN = re.compile(
    r"""\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|([A-Za-z_]\w*)"""
    r"""|(==|!=|<=|>=|[<>+|.()])|(\S))"""
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_CONSTANTS = {"true": True, "false": False, "none": None}
_BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "+": lambda a, b: a + b,
}


class TemplateError(ValueError):
    """A template that can't be parsed, or that asks for something it may not have."""


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str, filters: dict[str, Callable]) -> None:
        self.tokens: list[tuple[str, Any]] = []
        self.filters = filters
        for number, quoted, name, sign, bad in _TOKEN.findall(source):
            if bad:
                raise TemplateError(f"unexpected {bad!r}")
            if number:
                self.tokens.append(("const", int(number)))
            elif quoted:
                body = re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), quoted[1:-1], flags=re.S)
                self.tokens.append(("const", body))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
        self.at = 0

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            if kind != "const" and value in wanted:
                self.at += 1
                return value
        return None

    def whole(self) -> tuple:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def either(self) -> tuple:
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.added()
        while sign := self.take("==", "!=", "<=", ">=", "<", ">"):
            tree = ("binary", sign, tree, self.added())
        return tree

    def added(self) -> tuple:
        tree = self.filtered()
        while self.take("+"):
            tree = ("binary", "+", tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.operand()
        while True:
            if self.take("."):
                tree = ("field", tree, self.word())
            elif self.take("|"):
                name = self.word()
                if name not in self.filters:
                    raise TemplateError(f"unknown filter {name!r}")
                tree = ("filter", name, tree)
            else:
                return tree

    def word(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing")

    def operand(self) -> tuple:
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("a ) is missing")
            return tree
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            if kind == "const":
                self.at += 1
                return ("const", value)
            if kind == "name":
                self.at += 1
                return ("const", _CONSTANTS[value]) if value in _CONSTANTS else ("name", value)
        raise TemplateError("an expression is incomplete")


def parse(source: str, filters: dict[str, Callable]) -> tuple:
    """The syntax tree of a template."""
    parts = [p for p in _TAG.split(source) if p]
    at = 0

    def expression(text: str) -> tuple:
        return _Expression(text, filters).whole()

    def block(*ends: str) -> tuple[tuple, str, str]:
        """Nodes up to a tag among ends; that tag and what follows its word."""
        nonlocal at
        nodes = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{") and part.endswith("}}"):
                nodes.append(("print", expression(part[2:-2])))
            elif part.startswith("{%") and part.endswith("%}"):
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    return ("block", nodes), word, rest
                nodes.append(statement(word, rest))
            else:
                nodes.append(("text", part))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return ("block", nodes), "", ""

    def statement(word: str, rest: str) -> tuple:
        if word == "if":
            branches, test = [], expression(rest)
            while True:
                body, end, rest = block("elif", "else", "endif")
                branches.append((test, body))
                if end == "endif":
                    return ("if", branches)
                test = expression(rest) if end == "elif" else ("const", True)
        if word == "for":
            found = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
            if not found:
                raise TemplateError("for needs a name and an expression")
            return ("for", found[1], expression(found[2]), block("endfor")[0])
        if word == "set":
            found = re.fullmatch(r"([A-Za-z_]\w*)\s*=\s*(.+)", rest.strip(), re.S)
            if not found:
                raise TemplateError("set needs a name and an expression")
            return ("set", found[1], expression(found[2]))
        if word == "generation":
            return ("generation", block("endgeneration")[0])
        raise TemplateError(f"unknown tag {word!r}")

    return block()[0]


def fold(tree: tuple, filters: dict[str, Callable]) -> tuple:
    """The tree with constant parts computed."""
    kind = tree[0]
    if kind == "binary":
        a, b = fold(tree[2], filters), fold(tree[3], filters)
        if a[0] == b[0] == "const":
            try:
                return ("const", _BINARY[tree[1]](a[1], b[1]))
            except TypeError as e:
                raise TemplateError(str(e)) from e
        return (kind, tree[1], a, b)
    if kind == "not":
        inner = fold(tree[1], filters)
        return ("const", not inner[1]) if inner[0] == "const" else (kind, inner)
    if kind in ("and", "or"):
        a, b = fold(tree[1], filters), fold(tree[2], filters)
        if a[0] == "const":
            return b if bool(a[1]) == (kind == "and") else a
        return (kind, a, b)
    if kind == "filter":
        inner = fold(tree[2], filters)
        return ("const", filters[tree[1]](inner[1])) if inner[0] == "const" else (kind, tree[1], inner)
    if kind == "field":
        return (kind, fold(tree[1], filters), tree[2])
    if kind == "print":
        inner = fold(tree[1], filters)
        return ("text", _text(inner[1])) if inner[0] == "const" else (kind, inner)
    if kind == "if":
        branches = []
        for test, body in tree[1]:
            test = fold(test, filters)
            if test[0] == "const" and not test[1]:
                continue
            branches.append((test, fold(body, filters)))
            if test[0] == "const":
                break
        if branches and branches[0][0][0] == "const":
            return branches[0][1]
        return (kind, branches) if branches else ("block", [])
    if kind == "for":
        return (kind, tree[1], fold(tree[2], filters), fold(tree[3], filters))
    if kind == "set":
        return (kind, tree[1], fold(tree[2], filters))
    if kind == "generation":
        return (kind, fold(tree[1], filters))
    if kind == "block":
        nodes: list[tuple] = []
        for node in tree[1]:
            node = fold(node, filters)
            for own in node[1] if node[0] == "block" else [node]:
                if own[0] == "text" and nodes and nodes[-1][0] == "text":
                    nodes[-1] = ("text", nodes[-1][1] + own[1])
                elif own != ("text", ""):
                    nodes.append(own)
        return (kind, nodes)
    return tree


def _value(tree: tuple, filters: dict[str, Callable]) -> Callable[[dict], Any]:
    kind = tree[0]
    if kind == "const":
        constant = tree[1]
        return lambda names: constant
    if kind == "name":
        name = tree[1]
        return lambda names: names.get(name)
    if kind == "field":
        of, field = _value(tree[1], filters), tree[2]

        def get(names: dict) -> Any:
            whole = of(names)
            if whole is not None and not isinstance(whole, dict):
                raise TemplateError(f"no field {field!r} in a {type(whole).__name__}")
            return whole.get(field) if whole is not None else None

        return get
    if kind == "filter":
        change, inner = filters[tree[1]], _value(tree[2], filters)
        return lambda names: change(inner(names))
    if kind == "not":
        inner = _value(tree[1], filters)
        return lambda names: not inner(names)
    if kind in ("and", "or"):
        a, b = _value(tree[1], filters), _value(tree[2], filters)
        if kind == "and":
            return lambda names: a(names) and b(names)
        return lambda names: a(names) or b(names)
    operate, a, b = _BINARY[tree[1]], _value(tree[2], filters), _value(tree[3], filters)
    return lambda names: operate(a(names), b(names))


def _closure(tree: tuple, filters: dict[str, Callable], learned: bool) -> Callable[[dict, Emit], None]:
    kind = tree[0]
    if kind == "text":
        text = tree[1]
        return lambda names, emit: emit(text, learned)
    if kind == "print":
        value = _value(tree[1], filters)
        return lambda names, emit: emit(_text(value(names)), learned)
    if kind == "block":
        parts = [_closure(n, filters, learned) for n in tree[1]]

        def run(names: dict, emit: Emit) -> None:
            for part in parts:
                part(names, emit)

        return run
    if kind == "if":
        branches = [(_value(test, filters), _closure(body, filters, learned)) for test, body in tree[1]]

        def choose(names: dict, emit: Emit) -> None:
            for test, body in branches:
                if test(names):
                    body(names, emit)
                    return

        return choose
    if kind == "for":
        name, each, body = tree[1], _value(tree[2], filters), _closure(tree[3], filters, learned)

        def loop(names: dict, emit: Emit) -> None:
            for own in each(names) or ():
                names[name] = own
                body(names, emit)

        return loop
    if kind == "set":
        name, value = tree[1], _value(tree[2], filters)
        return lambda names, emit: names.__setitem__(name, value(names))
    return _closure(tree[1], filters, True)  # generation


def compile_template(source: str, **filters: Callable[[Any], Any]) -> Callable[[dict, Emit], None]:
    """A function of names and a receiver; it hands over each piece of text and whether it is learned."""
    known = FILTERS | filters
    return _closure(fold(parse(source, known), known), known, False)


def render(template: Callable[[dict, Emit], None], **names: Any) -> tuple[str, list[tuple[int, int]]]:
    """The whole text, and the start and end of each learned piece of it."""
    pieces: list[str] = []
    spans: list[tuple[int, int]] = []
    at = 0

    def emit(text: str, learned: bool) -> None:
        nonlocal at
        pieces.append(text)
        if learned and text:
            spans.append((at, at + len(text)))
        at += len(text)

    template(dict(names), emit)
    return "".join(pieces), spans


def stream(template: Callable[[dict, Emit], None], turns: Iterator[Any], receive: Emit, **names: Any) -> None:
    """Render over turns that are read one at a time, handing over pieces as they come."""
    template({**names, "turns": turns}, receive)
