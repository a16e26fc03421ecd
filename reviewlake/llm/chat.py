"""Chat formatting: a small sandboxed template language compiled to Python closures.

A template is parsed into a syntax tree, constants are folded (joined texts, constant
expressions, branches that can never run) and every node becomes a closure.  Rendering
yields pieces of text with a mark on those inside ``{% generation %}``, the loss mask.
The language has texts, ``{{ expression | filter }}``, ``{% for x in messages %}``,
``{% if %} {% elif %} {% else %}`` and ``{% generation %}``; expressions have literals,
names and their listed fields, ``loop.first``, ``loop.last``, ``loop.index0``, ``==``,
``!=``, ``in``, ``not``, ``and``, ``or`` and ``+``.  No call, import, attribute or item
beyond these exists, so a template can't reach Python.

Control strings inside texts are escaped reversibly: a ``<`` followed by any number of
backslashes and a ``|`` gets one more backslash, so ``<|`` only ever comes from the
template.

Conversations are rendered as a stream of turns sorted within each partition; one as
long as a third of the table passes through a task turn by turn and is never held
whole.  Edge cases, all defined: null texts and roles are empty; rows of equal turn are
ordered by role, then text, and repeated rows are turns of their own; a null conv_id is
a conversation; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import pick

START, STOP = "<|im_start|>", "<|im_end|>"
CHATML = (
    START + "{{ m.role | line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | guard }}{% endgeneration %}"
    "{% else %}{{ m.text | guard }}{% endif %}" + STOP + "\n"
)
CHATML = "{% for m in messages %}" + CHATML + "{% endfor %}"
PART_CHARS = 1 << 20  # an output row ends after the piece that passes this length


def guard(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unguard(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def line(text: str) -> str:
    """A text on one line: backslashes and line feeds are escaped first."""
    return guard(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unline(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unguard(text), flags=re.DOTALL)


FILTERS: dict[str, Callable[[str], str]] = {"guard": guard, "line": line, "trim": str.strip, "upper": str.upper, "lower": str.lower}
FIELDS = {"role", "text", "turn", "first", "last", "index0"}


class TemplateError(ValueError):
    pass


# ---- parsing -------------------------------------------------------------------

_TAGS = re.compile(r"\{\{.*?\}\}|\{%.*?%\}", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:(?P<num>\d+)|(?P<str>'[^']*'|\"[^\"]*\")|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[+|().]))")


def _tokens(src: str) -> list[tuple[str, str]]:
    out, at, src = [], 0, src.strip()
    while at < len(src):
        m = _TOKEN.match(src, at)
        if not m:
            raise TemplateError(f"unexpected {src[at:at + 10]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return [*out, ("end", "")]


class _Expression:
    """Recursive descent over one expression; nodes are tuples (kind, ...)."""

    def __init__(self, src: str):
        self.toks, self.at = _tokens(src), 0

    def take(self, *values: str) -> str | None:
        if self.toks[self.at][1] in values and self.toks[self.at][0] in ("op", "name"):
            self.at += 1
            return self.toks[self.at - 1][1]
        return None

    def whole(self):
        node = self.either()
        while self.take("|"):
            kind, name = self.toks[self.at]
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        if self.toks[self.at][0] != "end":
            raise TemplateError(f"unexpected {self.toks[self.at][1]!r}")
        return node

    def either(self):
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self):
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self):
        node = self.joined()
        op = self.take("==", "!=", "in")
        return (op, node, self.joined()) if op else node

    def joined(self):
        node = self.atom()
        while self.take("+"):
            node = ("+", node, self.atom())
        return node

    def atom(self):
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return node
        kind, value = self.toks[self.at]
        self.at += 1
        if kind == "num":
            return ("const", int(value))
        if kind == "str":
            return ("const", value[1:-1])
        if kind == "name" and value in ("true", "false"):
            return ("const", value == "true")
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        if not self.take("."):
            return ("name", value)
        field = self.toks[self.at][1]
        self.at += 1
        if field not in FIELDS:
            raise TemplateError(f"no field {field!r}")
        return ("field", value, field)


def parse(template: str) -> list:
    """The syntax tree: a list of nodes (text, put, for, if, generation)."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in _TAGS.finditer(template):
        parts.append(("text", template[at : m.start()]))
        parts.append(("put" if m[0].startswith("{{") else "tag", m[0][2:-2].strip()))
        at = m.end()
    parts.append(("text", template[at:]))
    stream = iter(parts)

    def block(*ends: str) -> tuple[list, str]:
        nodes: list = []
        for kind, body in stream:
            if kind == "text":
                nodes.append(("text", body))
            elif kind == "put":
                nodes.append(("put", _Expression(body).whole()))
            else:
                word = body.split(None, 1)[0] if body else ""
                if word in ends:
                    return nodes, body
                if word == "for":
                    m = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+messages", body)
                    if not m:
                        raise TemplateError(f"bad loop {body!r}")
                    nodes.append(("for", m[1], block("endfor")[0]))
                elif word == "generation":
                    nodes.append(("generation", block("endgeneration")[0]))
                elif word == "if":
                    arms, test = [], _Expression(body[2:]).whole()
                    while True:
                        inner, end = block("elif", "else", "endif")
                        arms.append((test, inner))
                        if end.startswith("elif"):
                            test = _Expression(end[4:]).whole()
                        elif end == "else":
                            test = ("const", True)
                        else:
                            break
                    nodes.append(("if", arms))
                else:
                    raise TemplateError(f"unknown tag {body!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return nodes, ""

    return block()[0]


# ---- constant folding ----------------------------------------------------------

_PURE = {
    "+": lambda a, b: _text(a) + _text(b) if isinstance(a, str) or isinstance(b, str) else a + b,
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: _text(a) in _text(b),
    "and": lambda a, b: a and b, "or": lambda a, b: a or b,
}


def _text(v) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v)


def fold_expression(e):
    if e[0] in ("const", "name", "field"):
        return e
    if e[0] == "filter":
        inner = fold_expression(e[2])
        return ("const", FILTERS[e[1]](_text(inner[1]))) if inner[0] == "const" else ("filter", e[1], inner)
    if e[0] == "not":
        inner = fold_expression(e[1])
        return ("const", not inner[1]) if inner[0] == "const" else ("not", inner)
    a, b = fold_expression(e[1]), fold_expression(e[2])
    if a[0] == b[0] == "const":
        return ("const", _PURE[e[0]](a[1], b[1]))
    return (e[0], a, b)


def fold(nodes: list) -> list:
    """The tree without constant work: texts joined, constant outputs made texts, dead branches gone."""
    out: list = []

    def text(s: str):
        if s:
            if out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + s)
            else:
                out.append(("text", s))

    def add(node):
        if node[0] == "text":
            text(node[1])
        else:
            out.append(node)

    for n in nodes:
        if n[0] == "text":
            text(n[1])
        elif n[0] == "put":
            e = fold_expression(n[1])
            if e[0] == "const":
                text(_text(e[1]))
            else:
                out.append(("put", e))
        elif n[0] == "for":
            out.append(("for", n[1], fold(n[2])))
        elif n[0] == "generation":
            out.append(("generation", fold(n[1])))
        else:
            arms = []
            for test, body in n[1]:
                e = fold_expression(test)
                if e[0] == "const" and not e[1]:
                    continue
                arms.append((e, fold(body)))
                if e[0] == "const":
                    break
            if arms and arms[0][0][0] == "const":
                for inner in arms[0][1]:
                    add(inner)
            elif arms:
                out.append(("if", arms))
    return out


# ---- closures ------------------------------------------------------------------

Piece = tuple[str, bool]


def _expression(e) -> Callable[[dict], object]:
    if e[0] == "const":
        value = e[1]
        return lambda env: value
    if e[0] == "name":
        name = e[1]
        return lambda env: env.get(name)
    if e[0] == "field":
        name, field = e[1], e[2]
        return lambda env: env.get(name, {}).get(field)
    if e[0] == "filter":
        f, inner = FILTERS[e[1]], _expression(e[2])
        return lambda env: f(_text(inner(env)))
    if e[0] == "not":
        inner = _expression(e[1])
        return lambda env: not inner(env)
    a, b = _expression(e[1]), _expression(e[2])
    if e[0] == "and":
        return lambda env: a(env) and b(env)
    if e[0] == "or":
        return lambda env: a(env) or b(env)
    op = _PURE[e[0]]
    return lambda env: op(a(env), b(env))


def _block(nodes: list) -> Callable[[dict, bool], Iterator[Piece]]:
    steps = [_node(n) for n in nodes]

    def run(env, marked):
        for s in steps:
            yield from s(env, marked)

    return run


def _node(n) -> Callable[[dict, bool], Iterator[Piece]]:
    if n[0] == "text":
        text = n[1]
        return lambda env, marked: iter(((text, marked),))
    if n[0] == "put":
        value = _expression(n[1])
        return lambda env, marked: iter(((_text(value(env)), marked),))
    if n[0] == "generation":
        body = _block(n[1])
        return lambda env, marked: body(env, True)
    if n[0] == "if":
        arms = [(_expression(t), _block(b)) for t, b in n[1]]

        def choose(env, marked):
            for test, body in arms:
                if test(env):
                    yield from body(env, marked)
                    return

        return choose
    name, body = n[1], _block(n[2])

    def loop(env, marked):
        rows = iter(env["messages"])
        now = next(rows, None)
        i = 0
        while now is not None:
            after = next(rows, None)  # one row ahead: loop.last without holding the conversation
            yield from body({**env, name: now, "loop": {"first": i == 0, "last": after is None, "index0": i}}, marked)
            now, i = after, i + 1

    return loop


def compile_template(template: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    run = _block(fold(parse(template)))
    return lambda messages: run({"messages": messages}, False)


# ---- on Spark ------------------------------------------------------------------

def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    return chain.from_iterable(zip(*(c.to_pylist() for c in b.columns), strict=True) for b in batches)


def format_conversations(conversations: DataFrame, template: str = CHATML) -> DataFrame:
    """(conv_id, part, start, text, loss array<struct<first, last>>): the formatted text in
    parts, each starting at code point ``start``; loss spans are half open, in the
    conversation's code points, and never cross a part.  The parts of a conversation
    follow each other in one partition."""
    rows = pick(conversations, "conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = T.StructType([
        rows.schema["conv_id"], T.StructField("part", T.LongType()), T.StructField("start", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("loss", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))),
    ])
    id_type = rows.schema["conv_id"].dataType
    compile_template(template)  # a bad template fails here, not on the executors

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        render = compile_template(template)
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        types = [to_arrow_type(id_type), pa.int64(), pa.int64(), pa.string(), span]
        out: list[tuple] = []
        held = 0

        def flush():
            nonlocal held
            cols = list(zip(*out, strict=True))
            out.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=schema.names)

        for conv, turns in groupby(_stream(batches), key=lambda r: r[0]):
            messages = ({"turn": t, "role": r or "", "text": x or ""} for _, t, r, x in turns)
            part = start = at = 0
            text: list[str] = []
            loss: list[dict] = []
            for piece, marked in render(messages):
                if marked and piece:
                    loss.append({"first": at, "last": at + len(piece)})
                text.append(piece)
                at += len(piece)
                if at - start >= PART_CHARS:
                    out.append((conv, part, start, "".join(text), loss))
                    part, start, text, loss = part + 1, at, [], []
                    yield flush()
            if text or not part:
                out.append((conv, part, start, "".join(text), loss))
                held += at - start
            if held >= PART_CHARS or len(out) >= 2000:
                yield flush()
        if out:
            yield flush()

    return rows.mapInArrow(run, schema)


def turns_of(parts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn, read back from formatted text that comes in parts."""
    left = ""
    for p in parts:
        left += p
        at = 0
        while (end := left.find(STOP + "\n", at)) >= 0:
            role, _, text = left[at + len(START) : end].partition("\n")
            yield unline(role), unguard(text)
            at = end + len(STOP) + 1
        left = left[at:]
    if left:
        raise ValueError(f"not a formatted conversation: {left[:40]!r}")


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from ``format_conversations`` of the default
    template: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    A narrow pass over the parts as they come, so it must follow the formatting directly
    or read a table sorted within its partitions by conv_id and part."""
    schema = T.StructType([
        formatted.schema["conv_id"], T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
    ])
    id_type = formatted.schema["conv_id"].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(id_type), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        out: list[tuple] = []
        for conv, parts in groupby(_stream(batches), key=lambda r: r[0]):
            loss, n = hashlib.sha256(), [0, 0]  # code points under the mask, and in all

            def texts(parts=parts, loss=loss, n=n):
                for _, _, start, text, spans in parts:
                    for s in spans:
                        plain = unguard(text[s["first"] - start : s["last"] - start])
                        loss.update(plain.encode())
                        n[0] += len(plain)
                    n[1] += len(text)
                    yield text

            turns, count = hashlib.sha256(), 0
            for role, text in turns_of(texts()):
                turns.update(f"{role}\n{text}\n".encode())
                count += 1
            out.append((conv, count, turns.hexdigest(), n[0], loss.hexdigest(), n[1]))
            if len(out) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names)
                out.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names)

    return formatted.mapInArrow(run, schema)
