"""A small sandboxed template language, compiled to Python closures.

Text stands for itself. `{{ expression }}` writes a value, `{# ... #}` is a comment, and
statements are `{% for x in xs %}`, `{% if %} / {% elif %} / {% else %}`, `{% set x = ... %}` and
`{% generation %} ... {% endgeneration %}`, which marks what a model shall learn to write. A
`-` inside a tag trims the white space beside it. Expressions have strings, whole numbers,
true, false, none, lists, `a if c else b`, or, and, not, comparisons, in, +, -, `~` (joins as
text), items (`x.name`, `x["name"]`, `x[0]`) and filters (`x | trim`).

The sandbox: names come from the caller's values and the template's own; items are looked up
in dicts and lists only, never as attributes of Python objects; there are no calls but of the
given filters; loops go over given values only. Errors are TemplateError, with the place.

`compile_template` parses to a syntax tree, folds what is constant (operators and filters on
constants, branches, neighbouring text) and turns every node into a closure.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

Piece = tuple[str, bool]  # text, and whether it stands in a generation block
Scope = dict[str, Any]
FILTERS: dict[str, Callable] = {"trim": lambda s: _text(s).strip(), "upper": lambda s: _text(s).upper(), "lower": lambda s: _text(s).lower(), "length": len}
TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?)(.*?)(-?)#\}", re.S)
TOKEN = re.compile(r"""\s*(?:(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<string>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<sign>==|!=|<=|>=|[-+~|.,()\[\]<>]))""", re.S)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
WORDS = {"true": True, "false": False, "none": None}
RESERVED = {"and", "or", "not", "in", "if", "else", "for", "set", *WORDS}


class TemplateError(ValueError):
    pass


def _text(value: Any) -> str:
    return value if isinstance(value, str) else "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def _sum(a: Any, b: Any) -> Any:
    if isinstance(a, str) != isinstance(b, str):
        raise TemplateError("+ takes two texts or two numbers; ~ joins anything")
    return a + b


BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "+": _sum,
    "-": lambda a, b: a - b,
    "~": lambda a, b: _text(a) + _text(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "not in": lambda a, b: a not in b,
}
LEVELS = (("==", "!=", "<", "<=", ">", ">=", "in", "not in"), ("+", "-", "~"))


# --- syntax tree --------------------------------------------------------------------


@dataclass
class Const:
    value: Any


@dataclass
class Name:
    name: str


@dataclass
class Apply:
    """An operator, item look-up, list or filter on its arguments; the function is pure."""

    work: Callable
    args: list


@dataclass
class Choice:
    """value if test else other; `and` and `or` are of this kind."""

    test: Any
    value: Any
    other: Any


@dataclass
class Write:
    value: Any


@dataclass
class Loop:
    name: str
    over: Any
    body: list


@dataclass
class Branch:
    test: Any
    body: list
    other: list


@dataclass
class Assign:
    name: str
    value: Any


@dataclass
class Generation:
    body: list


def item(value: Any, key: Any) -> Any:
    if isinstance(value, Mapping):
        return value.get(key)
    if isinstance(value, (list, tuple, str)) and isinstance(key, int):
        return value[key] if -len(value) <= key < len(value) else None
    raise TemplateError(f"no item {key!r} in a {type(value).__name__}")


class Expression:
    """Parser of one expression."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.source, self.filters, self.tokens, at = source, filters, [], 0
        while at < len(source.rstrip()):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"unexpected {source[at:].strip()[:20]!r}")
            self.tokens.append((found.lastgroup, found.group(found.lastgroup)))
            at = found.end()
        self.at = 0

    def parse(self) -> Any:
        tree = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {self.source.strip()!r}")
        return tree

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] in ("sign", "name") and self.tokens[self.at][1] in values

    def take(self, *values: str) -> bool:
        hit = self.peek(*values)
        self.at += hit
        return hit

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing in {self.source.strip()!r}")

    def choice(self) -> Any:
        value = self.either()
        if self.take("if"):
            test = self.either()
            self.need("else")
            return Choice(test, value, self.choice())
        return value

    def either(self) -> Any:
        value = self.both()
        while self.take("or"):
            value = Choice(value, value, self.both())
        return value

    def both(self) -> Any:
        value = self.negated()
        while self.take("and"):
            value = Choice(value, self.negated(), value)
        return value

    def negated(self) -> Any:
        if self.take("not"):
            return Apply(lambda v: not v, [self.negated()])
        return self.binary(0)

    def binary(self, level: int) -> Any:
        if level == len(LEVELS):
            return self.filtered()
        value = self.binary(level + 1)
        while True:
            sign = next((s for s in LEVELS[level] if self.peek(s)), None)
            if sign is None and "not in" in LEVELS[level] and self.peek("not") and self.tokens[self.at + 1 : self.at + 2] == [("name", "in")]:
                sign, self.at = "not in", self.at + 1
            if sign is None:
                return value
            self.at += 1
            value = Apply(BINARY[sign], [value, self.binary(level + 1)])

    def filtered(self) -> Any:
        value = self.items()
        while self.take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or name not in self.filters:
                raise TemplateError(f"unknown filter {name!r}")
            self.at += 1
            more = self.listed(")") if self.take("(") else []
            value = Apply(self.filters[name], [value, *more])
        return value

    def items(self) -> Any:
        value = self.atom()
        while True:
            if self.take("."):
                kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
                if kind != "name":
                    raise TemplateError(f"a name is missing after '.' in {self.source.strip()!r}")
                self.at += 1
                value = Apply(item, [value, Const(name)])
            elif self.take("["):
                value = Apply(item, [value, self.choice()])
                self.need("]")
            else:
                return value

    def listed(self, end: str) -> list:
        values = []
        while not self.take(end):
            values.append(self.choice())
            if not self.peek(end):
                self.need(",")
        return values

    def atom(self) -> Any:
        if self.take("("):
            value = self.choice()
            self.need(")")
            return value
        if self.take("["):
            return Apply(lambda *values: list(values), self.listed("]"))
        if self.take("-"):
            return Apply(lambda v: -v, [self.atom()])
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "the end")
        self.at += 1
        if kind == "number":
            return Const(int(value))
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "name" and value in WORDS:
            return Const(WORDS[value])
        if kind == "name" and value not in RESERVED:
            return Name(value)
        raise TemplateError(f"unexpected {value!r} in {self.source.strip()!r}")


def parse(source: str, filters: Mapping[str, Callable]) -> list:
    """The syntax tree of a template: a list of statements."""
    marks: list[tuple[str, str, int]] = []
    at, trim = 0, False
    for found in TAG.finditer(source):
        kind = 0 if found[2] is not None else 3 if found[5] is not None else 6
        text = source[at : found.start()]
        text = text.lstrip() if trim else text
        marks.append(("text", text.rstrip() if found[kind + 1] else text, at))
        if kind < 6:
            marks.append(("write" if kind == 0 else "tag", found[kind + 2].strip(), found.start()))
        at, trim = found.end(), bool(found[kind + 3])
    marks.append(("text", source[at:].lstrip() if trim else source[at:], at))
    expression = lambda s: Expression(s, filters).parse()
    place = 0

    def block(ends: tuple[str, ...]) -> tuple[list, str]:
        """Statements up to one of `ends`, and that tag."""
        nonlocal place
        body: list = []
        while place < len(marks):
            kind, value, where = marks[place]
            place += 1
            if kind == "text":
                body += [Write(Const(value))] if value else []
                continue
            try:
                if kind == "write":
                    body.append(Write(expression(value)))
                    continue
                word, _, rest = value.partition(" ")
                if word in ends:
                    return body, value
                if word == "for" and (m := re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)):
                    body.append(Loop(m[1], expression(m[2]), block(("endfor",))[0]))
                elif word == "set" and (m := re.fullmatch(r"([A-Za-z_]\w*)\s*=(?!=)(.+)", rest.strip(), re.S)):
                    body.append(Assign(m[1], expression(m[2])))
                elif word == "generation" and not rest:
                    body.append(Generation(block(("endgeneration",))[0]))
                elif word == "if":
                    body.append(branches(rest))
                else:
                    raise TemplateError(f"unexpected tag {value!r}")
            except TemplateError as error:
                raise error if "character" in str(error) else TemplateError(f"{error} (character {where})") from None
        if ends:
            raise TemplateError(f"{ends[-1]} is missing (character {len(source)})")
        return body, ""

    def branches(test: str) -> Branch:
        body, end = block(("elif", "else", "endif"))
        if end.startswith("elif"):
            return Branch(expression(test), body, [branches(end[4:])])
        return Branch(expression(test), body, block(("endif",))[0] if end == "else" else [])

    return block(())[0]


# --- constant folding ---------------------------------------------------------------


def fold(tree: Any) -> Any:
    """An expression with what is constant worked out; errors stay for the run."""
    if isinstance(tree, Apply):
        args = [fold(a) for a in tree.args]
        if all(isinstance(a, Const) for a in args):
            try:
                return Const(tree.work(*[a.value for a in args]))
            except Exception:  # noqa: BLE001
                pass
        return Apply(tree.work, args)
    if isinstance(tree, Choice):
        test = fold(tree.test)
        if isinstance(test, Const):
            return fold(tree.value if test.value else tree.other)
        return Choice(test, fold(tree.value), fold(tree.other))
    return tree


def fold_all(body: list) -> list:
    """Statements with constant expressions and branches settled and neighbouring text joined."""
    out: list = []
    for node in body:
        if isinstance(node, Write):
            value = fold(node.value)
            more = [Write(Const(_text(value.value)) if isinstance(value, Const) else value)]
        elif isinstance(node, Loop):
            over = fold(node.over)
            more = [] if isinstance(over, Const) and not over.value else [Loop(node.name, over, fold_all(node.body))]
        elif isinstance(node, Branch):
            test = fold(node.test)
            if isinstance(test, Const):
                more = fold_all(node.body if test.value else node.other)
            else:
                more = [Branch(test, fold_all(node.body), fold_all(node.other))]
        elif isinstance(node, Generation):
            more = [Generation(fold_all(node.body))]
        else:
            more = [Assign(node.name, fold(node.value))]
        for one in more:
            if isinstance(one, Write) and isinstance(one.value, Const):
                if not one.value.value:
                    continue
                if out and isinstance(out[-1], Write) and isinstance(out[-1].value, Const):
                    out[-1] = Write(Const(out[-1].value.value + one.value.value))
                    continue
            out.append(one)
    return out


# --- closures -----------------------------------------------------------------------


def value_of(tree: Any) -> Callable[[Scope], Any]:
    if isinstance(tree, Const):
        value = tree.value
        return lambda scope: value
    if isinstance(tree, Name):
        name = tree.name

        def look_up(scope: Scope) -> Any:
            if name not in scope:
                raise TemplateError(f"unknown name {name!r}")
            return scope[name]

        return look_up
    if isinstance(tree, Choice):
        test, yes, no = value_of(tree.test), value_of(tree.value), value_of(tree.other)
        return lambda scope: yes(scope) if test(scope) else no(scope)
    work, args = tree.work, [value_of(a) for a in tree.args]
    if len(args) == 1:
        one = args[0]
        return lambda scope: work(one(scope))
    if len(args) == 2:
        left, right = args
        return lambda scope: work(left(scope), right(scope))
    return lambda scope: work(*[a(scope) for a in args])


def writer_of(body: list, learn: bool = False) -> Callable[[Scope], Iterator[Piece]]:
    """A closure that yields the pieces of a list of statements."""
    steps = [_step(node, learn) for node in body]

    def run(scope: Scope) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)

    return run


def _step(node: Any, learn: bool) -> Callable[[Scope], Iterable[Piece]]:
    if isinstance(node, Write):
        if isinstance(node.value, Const):
            fixed = ((node.value.value, learn),)
            return lambda scope: fixed
        value = value_of(node.value)
        return lambda scope: ((_text(value(scope)), learn),)
    if isinstance(node, Generation):
        return writer_of(node.body, True)
    if isinstance(node, Branch):
        test, yes, no = value_of(node.test), writer_of(node.body, learn), writer_of(node.other, learn)
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if isinstance(node, Assign):
        name, value = node.name, value_of(node.value)

        def assign(scope: Scope) -> tuple:
            scope[name] = value(scope)
            return ()

        return assign
    name, over, body = node.name, value_of(node.over), writer_of(node.body, learn)

    def loop(scope: Scope) -> Iterator[Piece]:
        # one item is read ahead, so that the last one is known and no list is needed
        values, index, none = iter(over(scope)), 0, object()
        now = next(values, none)
        while now is not none:
            following = next(values, none)
            facts = {"index0": index, "index": index + 1, "first": index == 0, "last": following is none}
            yield from body({**scope, name: now, "loop": facts})
            now, index = following, index + 1

    return loop


@dataclass
class Template:
    tree: list
    write: Callable[[Scope], Iterator[Piece]]

    def pieces(self, **values: Any) -> Iterator[Piece]:
        return self.write(dict(values))

    def render(self, **values: Any) -> str:
        return "".join(text for text, _ in self.pieces(**values))

    def reads_once(self, name: str) -> bool:
        """The value is used by one loop outside of others and nowhere else, so it may be an iterator."""
        own = sum(isinstance(n, Loop) and n.over == Name(name) for n in self.tree)
        return own <= 1 and own == _uses(self.tree, name)


def _uses(tree: Any, name: str) -> int:
    if isinstance(tree, list):
        return sum(_uses(t, name) for t in tree)
    if isinstance(tree, Name):
        return int(tree.name == name)
    return sum(_uses(v, name) for v in vars(tree).values() if not isinstance(v, (str, Callable))) if hasattr(tree, "__dataclass_fields__") else 0


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Template:
    tree = fold_all(parse(source, {**FILTERS, **(filters or {})}))
    return Template(tree, writer_of(tree))
