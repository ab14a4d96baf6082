"""Chat templates: compiled to Python closures that write a conversation and mark what was generated.

A template is text with {{ expression }}, {% for x in e %}, {% if e %} / {% elif e %} / {% else %},
{% set x = e %}, {% generation %} and their {% end... %}, {# comments #}; a dash inside a delimiter strips
the white space on that side. Expressions have literals, names, x.key and x['key'], comparisons, in, and, or,
not, +, ~ (joins as text), a if c else b, and filters (x | trim). It is parsed into a syntax tree, constants
are folded (whole expressions, branches that cannot run, neighbouring text), and each node becomes a closure.

The language is a sandbox: names come from the given values only, a key is looked up in mappings only, filters
are the few below, there are no calls, and a template can loop over given sequences only, so it ends.

The escape filter makes sure that no control string of the template can come out of a text, and can be undone:
a control string gets a backslash after its first character, and one that has backslashes there gets one more.

Defined results of the Spark operator: a conversation's rows are taken by turn (null first), then role, then
text; null text and null roles are empty; rows without a conversation id are one conversation. A conversation
is one value of the result. Rows are sorted and streamed, so besides it a task holds a batch of rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONGEST_TEMPLATE = 100_000
DEEPEST = 30


class TemplateError(ValueError):
    """The template is not in the language, or asks for what the sandbox does not have."""


# Syntax tree: expressions.


@dataclass(frozen=True)
class Literal:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: Any
    key: Any


@dataclass(frozen=True)
class Unary:
    operand: Any


@dataclass(frozen=True)
class Binary:
    sign: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Choice:
    test: Any
    yes: Any
    no: Any


@dataclass(frozen=True)
class Filtered:
    value: Any
    name: str


# Syntax tree: statements. A body is a tuple of them.


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class Loop:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Branch:
    test: Any
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class Assign:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


PIECES = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
TOKEN = re.compile(r"""\s*(?:(?P<text>"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-+~<>()\[\].|=,]))""", re.S)
ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
CONSTANTS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}


class _Parser:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        source = source.strip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at : at + 20]!r}")
            self.tokens.append((found.lastgroup, found.group(found.lastgroup)))
            at = found.end()
        self.at = self.depth = 0

    def peek(self) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", None)
        return None if kind == "text" else value

    def take(self, *wanted: str) -> bool:
        if self.peek() in wanted and self.peek() is not None:
            self.at += 1
            return True
        return False

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing")

    def name(self) -> str:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        if kind != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return value

    def whole(self) -> Any:
        value = self.expression()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return value

    def expression(self) -> Any:
        self.depth += 1
        if self.depth > DEEPEST:
            raise TemplateError("expression nested too deeply")
        value = self.either()
        if self.take("if"):
            test = self.either()
            self.need("else")
            value = Choice(test, value, self.expression())
        self.depth -= 1
        return value

    def either(self) -> Any:
        value = self.both()
        while self.take("or"):
            value = Binary("or", value, self.both())
        return value

    def both(self) -> Any:
        value = self.negated()
        while self.take("and"):
            value = Binary("and", value, self.negated())
        return value

    def negated(self) -> Any:
        times = 0
        while self.take("not"):
            times += 1
        value = self.compared()
        for _ in range(times):
            value = Unary(value)
        return value

    def compared(self) -> Any:
        value = self.joined()
        while (sign := self.peek()) in ("==", "!=", "<", "<=", ">", ">=", "in"):
            self.at += 1
            value = Binary(sign, value, self.joined())
        return value

    def joined(self) -> Any:
        value = self.filtered()
        while (sign := self.peek()) in ("+", "~"):
            self.at += 1
            value = Binary(sign, value, self.filtered())
        return value

    def filtered(self) -> Any:
        value = self.primary()
        while True:
            if self.take("."):
                value = Key(value, Literal(self.name()))
            elif self.take("["):
                value = Key(value, self.expression())
                self.need("]")
            elif self.take("|"):
                value = Filtered(value, self.name())
            else:
                return value

    def primary(self) -> Any:
        if self.take("("):
            value = self.expression()
            self.need(")")
            return value
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
        self.at += 1
        if kind == "text":
            return Literal(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[0]), value[1:-1], flags=re.S))
        if kind == "number":
            return Literal(int(value))
        if kind == "name":
            return Literal(CONSTANTS[value]) if value in CONSTANTS else Name(value)
        raise TemplateError("a value is missing")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    if len(source) > LONGEST_TEMPLATE:
        raise TemplateError("template too long")
    pieces = PIECES.split(source)
    for k in range(1, len(pieces), 2):
        if pieces[k][2] == "-":
            pieces[k - 1] = pieces[k - 1].rstrip()
        if pieces[k][-3] == "-":
            pieces[k + 1] = pieces[k + 1].lstrip()
    queue = [(k % 2, piece) for k, piece in enumerate(pieces) if piece and not piece.startswith("{#")]
    queue.reverse()

    def body(depth: int, *ends: str) -> tuple[tuple, str]:
        if depth > DEEPEST:
            raise TemplateError("template nested too deeply")
        found: list[Any] = []
        while queue:
            tag, piece = queue.pop()
            if not tag:
                found.append(Output(Literal(piece)))
                continue
            inner = piece[2:-2].strip("-").strip()
            if piece.startswith("{{"):
                found.append(Output(_Parser(inner).whole()))
                continue
            word, _, rest = inner.partition(" ")
            if word in ends:
                return tuple(found), inner
            found.append(statement(word, rest, depth + 1))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(found), ""

    def branch(test: str, depth: int) -> Branch:
        yes, end = body(depth, "elif", "else", "endif")
        if end.startswith("elif"):
            return Branch(_Parser(test).whole(), yes, (branch(end[4:], depth),))
        no = body(depth, "endif")[0] if end == "else" else ()
        return Branch(_Parser(test).whole(), yes, no)

    def statement(word: str, rest: str, depth: int) -> Any:
        if word == "for":
            parser = _Parser(rest)
            name = parser.name()
            parser.need("in")
            return Loop(name, parser.whole(), body(depth, "endfor")[0])
        if word == "if":
            return branch(rest, depth)
        if word == "set":
            parser = _Parser(rest)
            name = parser.name()
            parser.need("=")
            return Assign(name, parser.whole())
        if word == "generation":
            return Generation(body(depth, "endgeneration")[0])
        raise TemplateError(f"unknown statement {word!r}")

    return body(0)[0]


def _key(of: Any, key: Any) -> Any:
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, (list, tuple)) and isinstance(key, int) and 0 <= key < len(of):
        return of[key]
    return None


BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "+": lambda a, b: a + b,
    "~": lambda a, b: as_text(a) + as_text(b),
}


def _joined(body: list[Any]) -> tuple:
    """Neighbouring text as one piece, empty text left out."""
    out: list[Any] = []
    for node in body:
        if isinstance(node, Output) and isinstance(node.value, Literal):
            if not node.value.value:
                continue
            if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Literal):
                node = Output(Literal(out.pop().value.value + node.value.value))
        out.append(node)
    return tuple(out)


def as_text(value: Any) -> str:
    return "" if value is None else str(value)


class Escaper:
    """Breaks control strings in texts, reversibly."""

    def __init__(self, control: tuple[str, ...]):
        if any(len(c) < 2 or c[0] in "".join(c[1:] for c in control) or "\\" in c for c in control):
            raise TemplateError("control strings have two characters or more, none a backslash or another's first one")
        parts = "|".join(f"(?<={re.escape(c[0])}){{}}(?={re.escape(c[1:])})" for c in sorted(control))
        self._out = re.compile(parts.replace("{}", r"(\\*)")) if control else None
        self._in = re.compile(parts.replace("{}", r"(\\+)")) if control else None

    def escape(self, text: str) -> str:
        return self._out.sub(lambda m: m[0] + "\\", text) if self._out else text

    def unescape(self, text: str) -> str:
        return self._in.sub(lambda m: m[0][1:], text) if self._in else text


class Writer:
    """Output of one rendering: parts of text, and the spans written inside generation blocks."""

    def __init__(self):
        self.parts: list[str] = []
        self.length = self.open = 0
        self.start = -1
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)

    def enter(self) -> None:
        if not self.open:
            self.start = self.length
        self.open += 1

    def leave(self) -> None:
        self.open -= 1
        if not self.open:
            self.spans.append((self.start, self.length))


class Template:
    """A compiled template. constants are values known beforehand, such as whether to ask for an answer."""

    def __init__(self, source: str, control: tuple[str, ...] = (), constants: dict[str, Any] | None = None):
        self.source, self.control, self.constants = source, control, constants or {}
        self.escaper = Escaper(control)
        self.filters: dict[str, Callable[[Any], Any]] = {
            "trim": lambda v: as_text(v).strip(),
            "upper": lambda v: as_text(v).upper(),
            "lower": lambda v: as_text(v).lower(),
            "length": len,
            "escape": lambda v: self.escaper.escape(as_text(v)),
        }
        self.tree = self.fold_body(parse(source), frozenset())
        self._run = self._body(self.tree)

    def __reduce__(self):  # closures stay behind; a worker compiles its own
        return Template, (self.source, self.control, self.constants)

    def render(self, **values: Any) -> tuple[str, list[tuple[int, int]]]:
        """(text, spans of generation blocks as code points)."""
        out = Writer()
        self._run({**self.constants, **values}, out)
        return "".join(out.parts), out.spans

    # Folding. assigned: names that the template itself sets, which are no constants.

    def fold(self, node: Any, assigned: frozenset) -> Any:
        if isinstance(node, Name):
            known = node.name in self.constants and node.name not in assigned
            return Literal(self.constants[node.name]) if known else node
        if isinstance(node, Choice):
            test = self.fold(node.test, assigned)
            if isinstance(test, Literal):
                return self.fold(node.yes if test.value else node.no, assigned)
            return Choice(test, self.fold(node.yes, assigned), self.fold(node.no, assigned))
        if isinstance(node, Binary):
            left, right = self.fold(node.left, assigned), self.fold(node.right, assigned)
            if node.sign in ("and", "or") and isinstance(left, Literal):
                return right if bool(left.value) == (node.sign == "and") else left
            folded = Binary(node.sign, left, right)
            return self._literal(folded) if isinstance(left, Literal) and isinstance(right, Literal) else folded
        if isinstance(node, Key):
            folded = Key(self.fold(node.of, assigned), self.fold(node.key, assigned))
            return self._literal(folded) if isinstance(folded.of, Literal) and isinstance(folded.key, Literal) else folded
        if isinstance(node, Unary):
            folded = Unary(self.fold(node.operand, assigned))
            return self._literal(folded) if isinstance(folded.operand, Literal) else folded
        if isinstance(node, Filtered):
            if node.name not in self.filters:
                raise TemplateError(f"unknown filter {node.name!r}")
            folded = Filtered(self.fold(node.value, assigned), node.name)
            return self._literal(folded) if isinstance(folded.value, Literal) else folded
        return node

    def _literal(self, node: Any) -> Literal:
        try:
            return Literal(self._value(node)({}))
        except TypeError as error:
            raise TemplateError(f"constants do not fit together: {error}") from error

    def fold_body(self, body: tuple, assigned: frozenset) -> tuple:
        out: list[Any] = []
        assigned |= {n.name for n in body if isinstance(n, Assign)}
        for node in body:
            if isinstance(node, Output):
                value = self.fold(node.value, assigned)
                out.append(Output(Literal(as_text(value.value)) if isinstance(value, Literal) else value))
            elif isinstance(node, Branch):
                test = self.fold(node.test, assigned)
                sides = [self.fold_body(side, assigned) for side in (node.yes, node.no)]
                if isinstance(test, Literal):
                    out += sides[0] if test.value else sides[1]
                elif any(sides):
                    out.append(Branch(test, *sides))
            elif isinstance(node, Loop):
                inner = self.fold_body(node.body, assigned | {node.name, "loop"})
                if inner:
                    out.append(Loop(node.name, self.fold(node.over, assigned), inner))
            elif isinstance(node, Generation):
                out.append(Generation(self.fold_body(node.body, assigned)))
            else:
                out.append(Assign(node.name, self.fold(node.value, assigned)))
        return _joined(out)

    # Closures.

    def _value(self, node: Any) -> Callable[[dict], Any]:
        if isinstance(node, Literal):
            return lambda values, value=node.value: value
        if isinstance(node, Name):
            return lambda values, name=node.name: values.get(name)
        if isinstance(node, Key):
            of, key = self._value(node.of), self._value(node.key)
            return lambda values: _key(of(values), key(values))
        if isinstance(node, Unary):
            operand = self._value(node.operand)
            return lambda values: not operand(values)
        if isinstance(node, Filtered):
            value, apply = self._value(node.value), self.filters[node.name]
            return lambda values: apply(value(values))
        if isinstance(node, Choice):
            test, yes, no = map(self._value, (node.test, node.yes, node.no))
            return lambda values: yes(values) if test(values) else no(values)
        left, right = self._value(node.left), self._value(node.right)
        if node.sign == "and":
            return lambda values: left(values) and right(values)
        if node.sign == "or":
            return lambda values: left(values) or right(values)
        apply = BINARY[node.sign]
        return lambda values: apply(left(values), right(values))

    def _body(self, body: tuple) -> Callable[[dict, Writer], None]:
        steps = [self._step(node) for node in body]

        def run(values: dict, out: Writer) -> None:
            for step in steps:
                step(values, out)

        return run

    def _step(self, node: Any) -> Callable[[dict, Writer], None]:
        if isinstance(node, Output):
            if isinstance(node.value, Literal):
                return lambda values, out, text=node.value.value: out.write(text)
            value = self._value(node.value)
            return lambda values, out: out.write(as_text(value(values)))
        if isinstance(node, Assign):
            value = self._value(node.value)
            return lambda values, out: values.__setitem__(node.name, value(values))
        if isinstance(node, Generation):
            inner = self._body(node.body)

            def generate(values: dict, out: Writer) -> None:
                out.enter()
                inner(values, out)
                out.leave()

            return generate
        if isinstance(node, Branch):
            test, yes, no = self._value(node.test), self._body(node.yes), self._body(node.no)
            return lambda values, out: yes(values, out) if test(values) else no(values, out)
        over, inner = self._value(node.over), self._body(node.body)

        def loop(values: dict, out: Writer) -> None:
            items = over(values) or ()
            if not isinstance(items, (list, tuple)):
                raise TemplateError(f"cannot loop over a {type(items).__name__}")
            own = dict(values)
            for k, item in enumerate(items):
                own[node.name] = item
                own["loop"] = {"index": k + 1, "index0": k, "first": k == 0, "last": k == len(items) - 1}
                inner(own, out)

        return loop


# The template of the query: every turn is headed by its role between [INST] and [/INST] and closed by </s>.
TURNS = """{{ bos }}{% for turn in messages -%}
[INST] {{ turn.role | escape }} [/INST] {% if turn.role == learned -%}
{% generation %}{{ turn.text | escape }}{% endgeneration %}
{%- else %}{{ turn.text | escape }}{% endif %}</s>{% endfor -%}
{% if ask %}[INST] {{ learned }} [/INST] {% endif %}"""
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
HEADED = re.compile(r"\[INST\] (.*?) \[/INST\] (.*?)</s>", re.S)


def turns_template(learned: str = "assistant", ask: bool = False) -> Template:
    """ask: end with the head of an answer, for use and not for training."""
    return Template(TURNS, CONTROL, {"bos": "<s>", "learned": learned, "ask": ask})


def turns_of(template: Template, text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from what turns_template has written."""
    undo = template.escaper.unescape
    return [(undo(role), undo(body)) for role, body in HEADED.findall(text)]


SCHEMA = "conversation {}, formatted string, spans array<struct<start:bigint,stop:bigint>>"


def format_conversations(rows: DataFrame, conversation: str, turn: str, role: str, text: str, template: Template) -> DataFrame:
    """(conversation, formatted, spans): every conversation written by a template over its messages (role, text)."""
    columns = {"conversation": conversation, "turn": turn, "role": role, "text": text}
    named = rows.select(*[F.col(old).alias(new) for new, old in columns.items()])
    dealt = named.repartition("conversation").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in columns])
    schema = SCHEMA.format(rows.schema[conversation].dataType.simpleString())
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def flow() -> Iterator[tuple]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conversation").type
                yield from zip(*[batch.column(c).to_pylist() for c in ("conversation", "role", "text")], strict=True)

        held: list[tuple] = []
        size = 0
        for name, turns in groupby(flow(), key=itemgetter(0)):
            messages = [{"role": r or "", "text": t or ""} for _, r, t in turns]
            written, spans = template.render(messages=messages)
            held.append((name, written, [{"start": a, "stop": b} for a, b in spans]))
            size += len(written)
            if size > 1 << 20:
                yield _batch(held, kind, span)
                held, size = [], 0
        if held:
            yield _batch(held, kind, span)

    return dealt.mapInArrow(run, schema)


def _batch(rows: list[tuple], kind: pa.DataType, span: pa.DataType) -> pa.RecordBatch:
    names, texts, spans = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, kind), pa.array(texts, pa.string()), pa.array(spans, span)], names=["conversation", "formatted", "spans"]
    )
