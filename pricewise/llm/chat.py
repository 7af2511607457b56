"""Chat formatting: a small sandboxed template language compiled to closures.

Language: text, ``{{ expression }}``, ``{% for m in messages %}``, ``{% if %}``
with ``elif`` and ``else``, and ``{% generation %}`` around what a model is
trained on. Expressions have string and whole-number literals, the fields of a
message, ``loop.first``, ``loop.last`` and ``loop.index``, ``== != and or not
~`` and the filters in ``FILTERS``. Nothing else can be named: no calls, no
attributes of Python objects, no other loops.

A template is parsed into a syntax tree; constant expressions, constant
branches and neighbouring text are folded; every node becomes a closure. A
template renders lazily over an iterator of messages, so a conversation is
never held whole: its output is one row per turn, in order, and each row has
the generation spans of its own text. The concatenated rows are the formatted
conversation.

Control strings inside texts are escaped with a backslash, so the output can
be read back exactly (``read_turns``).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import small_batches

HEAD, TAIL = "### ", "</turn>"
_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*):\n((?:[^\\<]+|\\.|<(?!/turn>))*+)</turn>\n", re.S)

TEMPLATE = (
    "{% for m in messages %}### {{ m.role | escape_role }}:\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "</turn>\n{% endfor %}")


def escape(text: str) -> str:
    """A backslash before every control string and backslash."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    """Like ``escape``, and before colons, which end a role."""
    return _ROLE_CONTROL.sub(lambda m: "\\" + m[0], role)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of formatted turns; fails on anything else in between."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError("the text is not a sequence of formatted turns")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "escape_role": escape_role, "trim": str.strip, "upper": str.upper, "lower": str.lower}
FIELDS = {"m": ("role", "text"), "loop": ("first", "last", "index")}


class TemplateError(ValueError):
    """The template is not in the language."""


# ---- syntax tree ---------------------------------------------------------------------------------

@dataclass
class Const:
    value: object


@dataclass
class Name:
    scope: str
    name: str


@dataclass
class Op:
    op: str
    args: list


@dataclass
class Text:
    value: str


@dataclass
class Output:
    expr: object


@dataclass
class If:
    branches: list              # (condition, body)
    other: list = field(default_factory=list)


@dataclass
class Generation:
    body: list


@dataclass
class For:
    var: str
    body: list


# ---- parser --------------------------------------------------------------------------------------

_PART = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[.~|()]))", re.S)
_ESCAPES = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over one expression, loosest operator first."""

    def __init__(self, source: str, var: str | None):
        self.items: list[tuple[str, object]] = []
        self.var, self.at, pos = var, 0, 0
        source = source.rstrip()
        while pos < len(source):
            m = _TOKEN.match(source, pos)
            if not m:
                raise TemplateError(f"cannot read {source[pos:pos + 20]!r}")
            pos = m.end()
            if m[1]:
                body = re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), m[1][1:-1], flags=re.S)
                self.items.append(("const", body))
            elif m[2]:
                self.items.append(("const", int(m[2])))
            else:
                self.items.append(("name", m[3]) if m[3] else ("op", m[4]))

    def peek(self, *values: str) -> bool:
        return self.at < len(self.items) and self.items[self.at][0] != "const" and self.items[self.at][1] in values

    def take(self) -> tuple[str, object]:
        if self.at == len(self.items):
            raise TemplateError("expression ends early")
        self.at += 1
        return self.items[self.at - 1]

    def parse(self):
        node = self.either()
        if self.at != len(self.items):
            raise TemplateError(f"unexpected {self.items[self.at][1]!r}")
        return node

    def _left(self, lower, *ops):
        node = lower()
        while self.peek(*ops):
            op = self.take()[1]
            node = Op(op, [node, lower()])
        return node

    def either(self):
        return self._left(self.both, "or")

    def both(self):
        return self._left(self.negated, "and")

    def negated(self):
        if self.peek("not"):
            self.take()
            return Op("not", [self.negated()])
        return self._left(self.joined, "==", "!=")

    def joined(self):
        return self._left(self.filtered, "~")

    def filtered(self):
        node = self.atom()
        while self.peek("|"):
            self.take()
            name = self.take()[1]
            if name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            node = Op("|" + name, [node])
        return node

    def atom(self):
        kind, value = self.take()
        if kind == "const":
            return Const(value)
        if value == "(":
            node = self.either()
            if not self.peek(")"):
                raise TemplateError("missing )")
            self.take()
            return node
        if kind == "name" and value in ("true", "false"):
            return Const(value == "true")
        if kind == "name" and self.peek("."):
            self.take()
            name = self.take()[1]
            scope = "m" if self.var and value == self.var else value if value == "loop" and self.var else None
            if scope and name in FIELDS[scope]:
                return Name(scope, name)
        raise TemplateError(f"{value!r} is not known here")


def parse(source: str) -> list:
    """Syntax tree of a template."""
    root: list = []
    stack: list[tuple[str, object, list]] = [("", None, root)]      # (block, node, where its body goes)
    var, at = None, 0

    def add(node) -> None:
        stack[-1][2].append(node)

    for m in [*_PART.finditer(source), None]:
        end = m.start() if m else len(source)
        if end > at:
            add(Text(source[at:end]))
        if m is None:
            break
        at = m.end()
        if m[1] is not None:
            add(Output(_Expression(m[1], var).parse()))
            continue
        words = m[2].split()
        word, rest = (words[0] if words else ""), m[2].strip()[len(words[0]) if words else 0:]
        kind, node, _ = stack[-1]
        if word == "for":
            if var or len(words) != 4 or words[2:] != ["in", "messages"] or not words[1].isidentifier() \
                    or words[1] == "loop":
                raise TemplateError("only one loop level, over messages")
            var = words[1]
            node = For(var, [])
            add(node)
            stack.append(("for", node, node.body))
        elif word == "if":
            node = If([(_Expression(rest, var).parse(), [])])
            add(node)
            stack.append(("if", node, node.branches[0][1]))
        elif word == "elif" and kind == "if":
            node.branches.append((_Expression(rest, var).parse(), []))
            stack[-1] = ("if", node, node.branches[-1][1])
        elif word == "else" and kind == "if":
            stack[-1] = ("else", node, node.other)
        elif word == "generation":
            if any(k == "generation" for k, _, _ in stack):
                raise TemplateError("generation inside generation")
            node = Generation([])
            add(node)
            stack.append(("generation", node, node.body))
        elif word in ("endfor", "endif", "endgeneration") and kind in {
                "endfor": ("for",), "endif": ("if", "else"), "endgeneration": ("generation",)}[word]:
            stack.pop()
            var = None if word == "endfor" else var
        else:
            raise TemplateError(f"unexpected block {m[2].strip()!r}")
    if len(stack) > 1:
        raise TemplateError(f"block {stack[-1][0]!r} is not closed")
    return root


# ---- constant folding ----------------------------------------------------------------------------

def _text(value: object) -> str:
    return "" if value is None else ("true" if value else "false") if isinstance(value, bool) else str(value)


def _apply(op: str, args: list):
    if op.startswith("|"):
        return FILTERS[op[1:]](_text(args[0]))
    if op == "not":
        return not args[0]
    a, b = args
    return {"==": lambda: a == b, "!=": lambda: a != b, "~": lambda: _text(a) + _text(b),
            "and": lambda: a and b, "or": lambda: a or b}[op]()


def _fold_expr(e):
    if not isinstance(e, Op):
        return e
    args = [_fold_expr(a) for a in e.args]
    if all(isinstance(a, Const) for a in args):
        return Const(_apply(e.op, [a.value for a in args]))
    if e.op in ("and", "or") and isinstance(args[0], Const):
        return args[1] if bool(args[0].value) == (e.op == "and") else args[0]
    return Op(e.op, args)


def fold(body: list) -> list:
    """The tree without constant outputs, dead branches and split text."""
    out: list = []

    def add(node) -> None:
        if isinstance(node, Text):
            if not node.value:
                return
            if out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].value + node.value)
                return
        out.append(node)

    for node in body:
        if isinstance(node, Output):
            e = _fold_expr(node.expr)
            add(Text(_text(e.value)) if isinstance(e, Const) else Output(e))
        elif isinstance(node, If):
            live, other = [], node.other
            for cond, inner in node.branches:
                c = _fold_expr(cond)
                if isinstance(c, Const) and not c.value:
                    continue
                if isinstance(c, Const):
                    other = inner
                    break
                live.append((c, fold(inner)))
            other = fold(other)
            if live:
                add(If(live, other))
            else:
                for n in other:
                    add(n)
        elif isinstance(node, Generation):
            inner = fold(node.body)
            if inner:
                add(Generation(inner))
        elif isinstance(node, For):
            add(For(node.var, fold(node.body)))
        else:
            add(node)
    return out


# ---- closures ------------------------------------------------------------------------------------

def _compile_expr(e) -> Callable:
    if isinstance(e, Const):
        value = e.value
        return lambda env: value
    if isinstance(e, Name):
        key = (e.scope, e.name)
        return lambda env: env[key]
    args = [_compile_expr(a) for a in e.args]
    if e.op.startswith("|"):
        apply, (arg,) = FILTERS[e.op[1:]], args
        return lambda env: apply(_text(arg(env)))
    if e.op == "not":
        return lambda env: not args[0](env)
    a, b = args
    if e.op == "and":
        return lambda env: a(env) and b(env)
    if e.op == "or":
        return lambda env: a(env) or b(env)
    if e.op == "~":
        return lambda env: _text(a(env)) + _text(b(env))
    return (lambda env: a(env) == b(env)) if e.op == "==" else (lambda env: a(env) != b(env))


TURN_END = object()         # yielded by a template after each message


def _compile(body: list) -> Callable[[dict, bool], Iterator]:
    """A closure that yields (text, is generation) pieces and ``TURN_END`` marks."""
    parts = []
    for node in body:
        if isinstance(node, Text):
            parts.append(lambda env, gen, v=node.value: iter(((v, gen),)))
        elif isinstance(node, Output):
            parts.append(lambda env, gen, f=_compile_expr(node.expr): iter(((_text(f(env)), gen),)))
        elif isinstance(node, Generation):
            parts.append(lambda env, gen, f=_compile(node.body): f(env, True))
        elif isinstance(node, If):
            branches = [(_compile_expr(c), _compile(b)) for c, b in node.branches]
            parts.append(lambda env, gen, bs=branches, o=_compile(node.other):
                         next((f for c, f in bs if c(env)), o)(env, gen))
        else:
            parts.append(_loop(_compile(node.body)))

    def run(env, gen):
        for p in parts:
            yield from p(env, gen)
    return run


def _loop(inner: Callable) -> Callable:
    def run(env, gen):
        messages = iter(env["messages"])
        ahead, index = next(messages, None), 0
        while ahead is not None:
            (role, text), ahead = ahead, next(messages, None)
            index += 1
            own = {("m", "role"): role, ("m", "text"): text, ("loop", "first"): index == 1,
                   ("loop", "last"): ahead is None, ("loop", "index"): index}
            yield from inner(own, gen)
            yield TURN_END, False
    return run


@dataclass
class Template:
    """A compiled template."""

    source: str = TEMPLATE

    def __post_init__(self):
        tree = fold(parse(self.source))
        if sum(isinstance(n, For) for n in tree) != 1:
            raise TemplateError("a template has one loop over messages, outside other blocks")
        self.run = _compile(tree)

    def segments(self, messages: Iterable[tuple[str, str]]) -> Iterator[tuple[str, list[int]]]:
        """Per turn its text and generation spans (code points: start, end, start, ...).

        What precedes the loop belongs to the first turn and what follows it to
        the last; each turn is given out once the next one is known to begin.
        """
        text: list[str] = []
        spans: list[int] = []
        size, done = 0, None
        for piece, gen in self.run({"messages": messages}, False):
            if piece is TURN_END:
                if done:
                    yield done
                done, text, spans, size = ("".join(text), spans), [], [], 0
                continue
            if gen and piece:
                if spans and spans[-1] == size:
                    spans[-1] += len(piece)
                else:
                    spans += [size, size + len(piece)]
            text.append(piece)
            size += len(piece)
        if done:
            rest = len(done[0])
            yield done[0] + "".join(text), done[1] + [s + rest for s in spans]


# ---- Spark ---------------------------------------------------------------------------------------

_BATCH_CHARS = 4_000_000


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


def format_turns(conversations: DataFrame, template: str = TEMPLATE, conv_id: str = "conv_id",
                 turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: conv_id, seq (from 0), segment, spans; rows of a conversation in order.

    Rows are ordered by turn (nulls first); ties by role, then text, so repeated
    rows are kept, side by side. Null roles and texts count as empty ones. Rows
    with a null conv_id form one conversation of their own. An empty table
    gives no rows; other columns are not read. A conversation is read in order
    by one task that holds two turns at a time, however many there are; the
    sort before it spills to disk.
    """
    small_batches(conversations.sparkSession)
    Template(template)      # fail on the driver, not in a task
    src = conversations.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    ordered = src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text") \
        .select("conv_id", "role", "text")
    schema = T.StructType([ordered.schema[0], T.StructField("seq", T.LongType()),
                           T.StructField("segment", T.StringType()),
                           T.StructField("spans", T.ArrayType(T.LongType()))])

    def run(batches):
        made = Template(template)
        out: list[tuple] = []
        size = 0
        rows = ((c, r, t) for b in batches for c, r, t in zip(*(b.column(i).to_pylist() for i in range(3))))
        ahead = next(rows, None)

        def messages(conv):
            nonlocal ahead
            while ahead is not None and ahead[0] == conv:
                yield ahead[1], ahead[2]
                ahead = next(rows, None)

        kind = pa.schema([("conv_id", pa.int64() if id_type == "bigint" else pa.string()), ("seq", pa.int64()),
                          ("segment", pa.string()), ("spans", pa.list_(pa.int64()))])
        while ahead is not None:
            conv = ahead[0]
            for seq, (segment, spans) in enumerate(made.segments(messages(conv))):
                out.append((conv, seq, segment, spans))
                size += len(segment)
                if size >= _BATCH_CHARS or len(out) >= 5000:
                    yield _emit(out, kind)
                    out, size = [], 0
        if out:
            yield _emit(out, kind)

    id_type = ordered.schema[0].dataType.simpleString()
    if id_type not in ("bigint", "string"):
        raise ValueError("conv_id must be a long or a string")
    return ordered.mapInArrow(run, schema)


def digests(turns: DataFrame) -> DataFrame:
    """What ``format_turns`` wrote in the default template, read back per conversation.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn),
    loss_chars and loss_sha256 (the unescaped text under the generation spans),
    formatted_chars. It follows ``format_turns`` in the same tasks and holds
    one turn and two running digests.
    """
    id_field = turns.schema["conv_id"]
    schema = T.StructType([id_field, T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                           T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
                           T.StructField("formatted_chars", T.LongType())])
    id_type = pa.int64() if id_field.dataType.simpleString() == "bigint" else pa.string()

    def run(batches):
        kind = pa.schema([("conv_id", id_type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                          ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        now, out = None, []

        def close():
            out.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

        for batch in batches:
            for conv, seq, segment, spans in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if seq == 0:
                    if now:
                        close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(segment):
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                loss = unescape("".join(segment[s:e] for s, e in zip(spans[::2], spans[1::2])))
                now[3] += len(loss)
                now[4].update(loss.encode())
                now[5] += len(segment)
            if len(out) >= 5000:
                yield _emit(out, kind)
                out.clear()
        if now:
            close()
        if out:
            yield _emit(out, kind)

    return turns.select("conv_id", "seq", "segment", "spans").mapInArrow(run, schema)
