"""A small sandboxed template language, compiled to closures.

Text, ``{{ expression }}``, ``{% if %} / {% elif %} / {% else %}``, ``{% for x in xs %}`` (with ``loop.index0``,
``loop.first``, ``loop.last``), ``{% set x = ... %}``, ``{% generation %} ... {% endgeneration %}`` and ``{# comments #}``;
a ``-`` inside a delimiter trims the white space beside it. Expressions: strings, integers, true, false,
none, names, ``.key`` and ``[key]`` on mappings and lists, ``== != < > in``, ``and or not``, ``+`` and ``~``, and the
filters given to the compiler. There are no calls and no attribute access on objects, so a template can
reach nothing but its scope.

``compile_template`` parses to a tree, folds what depends only on literals and the given constants
(expressions, conditions, neighbouring text), and turns each node into a generator closure. Rendering is
lazy: it yields (text, inside a generation block), and ``TURN`` (no text) after each pass of an outermost loop, so a
conversation of any length streams through."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

TURN = (None, False)
PARTS = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?).*?(-?)#\}", re.S)
WORDS = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[-+~|.\[\]()<>=]))")
SIMPLE = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    pass


def _chunks(source: str) -> list[tuple[str, str]]:
    out, at, trim = [], 0, False
    for m in PARTS.finditer(source):
        text = source[at:m.start()]
        at = m.end()
        left = "-" in (m[1], m[4], m[7])
        text = text.lstrip() if trim else text
        out.append(("text", text.rstrip() if left else text))
        trim = "-" in (m[3], m[6], m[8])
        if m[2] is not None:
            out.append(("print", m[2].strip()))
        elif m[5] is not None:
            out.append(("block", m[5].strip()))
    tail = source[at:]
    out.append(("text", tail.lstrip() if trim else tail))
    return [c for c in out if c[0] != "text" or c[1]]


class _Expression:
    """Recursive descent over one expression; nodes are tuples, literals ('lit', value)."""

    def __init__(self, text: str) -> None:
        self.words, at = [], 0
        text = text.strip()
        while at < len(text):
            m = WORDS.match(text, at)
            if not m:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.words.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.words) and self.words[self.at][0] in ("op", "name") and self.words[self.at][1] in values

    def take(self, *values: str) -> bool:
        if self.peek(*values):
            self.at += 1
            return True
        return False

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r}")

    def name(self) -> str:
        if self.at < len(self.words) and self.words[self.at][0] == "name":
            self.at += 1
            return self.words[self.at - 1][1]
        raise TemplateError("expected a name")

    def whole(self) -> tuple:
        out = self.either()
        if self.at < len(self.words):
            raise TemplateError(f"unexpected {self.words[self.at][1]!r}")
        return out

    def either(self) -> tuple:
        out = self.both()
        while self.take("or"):
            out = ("or", out, self.both())
        return out

    def both(self) -> tuple:
        out = self.negation()
        while self.take("and"):
            out = ("and", out, self.negation())
        return out

    def negation(self) -> tuple:
        return ("not", self.negation()) if self.take("not") else self.comparison()

    def comparison(self) -> tuple:
        out = self.sum()
        while self.peek("==", "!=", "<", ">", "in"):
            op = self.words[self.at][1]
            self.at += 1
            out = (op, out, self.sum())
        return out

    def sum(self) -> tuple:
        out = self.filtered()
        while self.peek("+", "~"):
            op = self.words[self.at][1]
            self.at += 1
            out = (op, out, self.filtered())
        return out

    def filtered(self) -> tuple:
        out = self.access()
        while self.take("|"):
            out = ("filter", out, self.name())
        return out

    def access(self) -> tuple:
        out = self.single()
        while True:
            if self.take("."):
                out = ("get", out, ("lit", self.name()))
            elif self.take("["):
                out = ("get", out, self.either())
                self.need("]")
            else:
                return out

    def single(self) -> tuple:
        if self.take("("):
            out = self.either()
            self.need(")")
            return out
        if self.at >= len(self.words):
            raise TemplateError("expression ends too soon")
        kind, value = self.words[self.at]
        self.at += 1
        if kind == "str":
            return ("lit", re.sub(r"\\(.)", lambda m: SIMPLE.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "int":
            return ("lit", int(value))
        if kind == "name":
            known = {"true": True, "false": False, "none": None}
            return ("lit", known[value]) if value in known else ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def _parse(chunks: list[tuple[str, str]], at: int, ends: tuple[str, ...]) -> tuple[list, int, str]:
    """Nodes up to a block that starts with one of `ends`; (nodes, index after it, that block)."""
    out: list = []
    while at < len(chunks):
        kind, body = chunks[at]
        at += 1
        if kind == "text":
            out.append(("text", body))
        elif kind == "print":
            out.append(("print", _Expression(body).whole()))
        else:
            word, _, rest = body.partition(" ")
            if word in ends:
                return out, at, body
            if word == "if":
                arms, test = [], rest
                while True:
                    inner, at, stop = _parse(chunks, at, ("elif", "else", "endif"))
                    arms.append((("lit", True) if test is None else _Expression(test).whole(), inner))
                    end, _, more = stop.partition(" ")
                    if end == "endif":
                        break
                    test = more if end == "elif" else None
                out.append(("if", arms))
            elif word == "for":
                name, found, source = (x.strip() for x in rest.partition(" in "))
                if not found or not name.isidentifier():
                    raise TemplateError(f"cannot read loop {body!r}")
                inner, at, _ = _parse(chunks, at, ("endfor",))
                out.append(("for", name, _Expression(source).whole(), inner))
            elif word == "generation":
                inner, at, _ = _parse(chunks, at, ("endgeneration",))
                out.append(("generation", inner))
            elif word == "set":
                name, found, value = (x.strip() for x in rest.partition("="))
                if not found or not name.isidentifier():
                    raise TemplateError(f"cannot read assignment {body!r}")
                out.append(("set", name, _Expression(value).whole()))
            else:
                raise TemplateError(f"unknown block {word!r}")
    if ends:
        raise TemplateError(f"missing {ends[-1]!r}")
    return out, at, ""


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _member(box: object, key: object) -> object:
    if isinstance(box, dict):
        return box.get(key)
    if isinstance(box, (list, tuple, str)) and isinstance(key, int) and -len(box) <= key < len(box):
        return box[key]
    return None


BINARY: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b, "in": lambda a, b: a in b,
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b), "~": lambda a, b: _text(a) + _text(b),
    "get": _member,
}


class _Compiler:
    def __init__(self, filters: dict[str, Callable], constants: dict) -> None:
        self.filters, self.constants = filters, constants

    # expressions: (is constant, value) or (False, closure over the scope)
    def expression(self, node: tuple, bound: frozenset) -> tuple[bool, object]:
        kind = node[0]
        if kind == "lit":
            return True, node[1]
        if kind == "name":
            name = node[1]
            if name in self.constants and name not in bound:
                return True, self.constants[name]
            return False, lambda scope: scope.get(name)
        if kind == "filter":
            if node[2] not in self.filters:
                raise TemplateError(f"unknown filter {node[2]!r}")
            return self._apply(self.filters[node[2]], [self.expression(node[1], bound)])
        if kind == "not":
            return self._apply(lambda a: not a, [self.expression(node[1], bound)])
        parts = [self.expression(n, bound) for n in node[1:]]
        if kind in ("and", "or"):
            (fixed, a), (also, b) = parts
            if fixed:
                return parts[1] if bool(a) == (kind == "and") else parts[0]
            right = (lambda scope: b) if also else b
            return False, (lambda scope: a(scope) and right(scope)) if kind == "and" else (lambda scope: a(scope) or right(scope))
        return self._apply(BINARY[kind], parts)

    @staticmethod
    def _apply(fn: Callable, parts: list[tuple[bool, object]]) -> tuple[bool, object]:
        if all(fixed for fixed, _ in parts):
            return True, fn(*(v for _, v in parts))
        getters = [(lambda scope, v=v: v) if fixed else v for fixed, v in parts]
        if len(getters) == 1:
            one = getters[0]
            return False, lambda scope: fn(one(scope))
        left, right = getters
        return False, lambda scope: fn(left(scope), right(scope))

    def fold(self, nodes: list, bound: frozenset) -> list:
        """Closures and plain strings, with what is constant evaluated and neighbouring text joined."""
        out: list = []

        def add(x: object) -> None:
            if isinstance(x, str) and out and isinstance(out[-1], str):
                out[-1] += x
            elif x != "":
                out.append(x)

        for node in nodes:
            kind = node[0]
            if kind == "text":
                add(node[1])
            elif kind == "print":
                fixed, v = self.expression(node[1], bound)
                add(_text(v) if fixed else self._print(v))
            elif kind == "if":
                arms = []
                for test, inner in node[1]:
                    fixed, v = self.expression(test, bound)
                    if fixed and not v:
                        continue
                    arms.append((None if fixed else v, self.fold(inner, bound)))
                    if fixed:
                        break
                if arms and arms[0][0] is None:
                    for x in arms[0][1]:
                        add(x)
                elif arms:
                    add(self._choice([(t, self.block(b)) for t, b in arms]))
            elif kind == "for":
                fixed, v = self.expression(node[2], bound)
                add(self._loop(node[1], (lambda scope, v=v: v) if fixed else v, self.block(self.fold(node[3], bound | {node[1], "loop"}))))
            elif kind == "generation":
                add(self._marked(self.block(self.fold(node[1], bound))))
            else:
                fixed, v = self.expression(node[2], bound)
                bound = bound | {node[1]}
                add(self._assign(node[1], (lambda scope, v=v: v) if fixed else v))
        return out

    @staticmethod
    def block(parts: list) -> Callable:
        def run(scope: dict) -> Iterator[tuple]:
            for p in parts:
                if isinstance(p, str):
                    yield p, False
                else:
                    yield from p(scope)
        return run

    @staticmethod
    def _print(value: Callable) -> Callable:
        def run(scope: dict) -> Iterator[tuple]:
            yield _text(value(scope)), False
        return run

    @staticmethod
    def _choice(arms: list) -> Callable:
        def run(scope: dict) -> Iterator[tuple]:
            for test, body in arms:
                if test is None or test(scope):
                    yield from body(scope)
                    return
        return run

    @staticmethod
    def _marked(body: Callable) -> Callable:
        def run(scope: dict) -> Iterator[tuple]:
            for text, _ in body(scope):
                yield text, True
        return run

    @staticmethod
    def _assign(name: str, value: Callable) -> Callable:
        def run(scope: dict) -> Iterator[tuple]:
            scope[name] = value(scope)
            return iter(())
        return run

    @staticmethod
    def _loop(name: str, source: Callable, body: Callable) -> Callable:
        def run(scope: dict) -> Iterator[tuple]:
            it = iter(source(scope) or ())
            outer = "loop" not in scope
            item = next(it, TURN)
            index = 0
            while item is not TURN:
                following = next(it, TURN)
                inner = dict(scope)
                inner[name] = item
                inner["loop"] = {"index0": index, "first": index == 0, "last": following is TURN}
                yield from body(inner)
                if outer:
                    yield TURN
                item, index = following, index + 1
        return run


def compile_template(source: str, filters: dict[str, Callable], constants: dict | None = None) -> Callable[[Iterable[dict]], Iterator[tuple]]:
    """A function from messages (any iterable of mappings) to an iterator of (text, inside generation) and TURN."""
    compiler = _Compiler(filters, constants or {})
    nodes, _, _ = _parse(_chunks(source), 0, ())
    body = compiler.block(compiler.fold(nodes, frozenset()))
    return lambda messages: body({"messages": messages})
