"""Chat formatting: a compiler for a small sandboxed template language.

A template is text with ``{{ expression }}``, ``{% if %}/{% elif %}/{% else %}/{% endif %}``, ``{% for x in list %}/
{% endfor %}``, ``{% set name = expression %}`` and ``{% generation %}/{% endgeneration %}``, which marks what a model
is trained to say. Expressions have literals, names, fields (``message.role``), comparison, ``and``/``or``/``not``,
``~`` (joining), ``in``, and the filters ``escape``, ``trim``, ``upper``, ``lower`` and ``default``. There is no call,
no index into Python objects and no attribute but a mapping's keys, and nothing is evaluated by Python from text.

Compilation: tokens, a syntax tree, constant folding (branches on constants and joins of literals go), then nested
Python closures that render a conversation into text pieces and training spans.

Control strings inside message texts are escaped reversibly, so a text can never open or close a turn, and
``read_turns`` recovers the turns from the formatted text alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.common import col, ship

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[END]")
TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'system' %}[SYS] {{ m.text | escape }} [/SYS]"
    "{% elif m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}<s>{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ m.role | escape }}[/ROLE]{{ m.text | escape }}[END]{% endif %}\n"
    "{% endfor %}"
)

# Escaping ----------------------------------------------------------------------------------------------------------

_ESCAPED = re.compile("|".join(["\\\\", *(re.escape(c) for c in sorted(CONTROLS, key=len, reverse=True))]))
_LETTERS = {"<": "l", "[": "b"}
_FIRST = {v: k for k, v in _LETTERS.items()}


def escape(text: str) -> str:
    r"""Write ``\`` as ``\\`` and a control string's first character as ``\`` and a letter.

    No control string has a ``<``, ``[`` or ``\`` but at its start, so what is left of one can't be part of another.
    """
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else f"\\{_LETTERS[m[0][0]]}{m[0][1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _FIRST.get(m[1], m[1]), text, flags=re.DOTALL)


# Parsing -----------------------------------------------------------------------------------------------------------


class Node(NamedTuple):
    kind: str
    parts: tuple


class TemplateError(ValueError):
    pass


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.DOTALL)
_WORD = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[|.()~=]))""")
_BACKSLASH = {"n": "\n", "t": "\t", "r": "\r"}


def _words(source: str) -> list[tuple[str, Any]]:
    words, at = [], 0
    while source[at:].strip():
        m = _WORD.match(source, at)
        if not m:
            raise TemplateError(f"unexpected {source[at:].strip()[:20]!r}")
        if m[1]:
            words.append(("literal", re.sub(r"\\(.)", lambda x: _BACKSLASH.get(x[1], x[1]), m[1][1:-1])))
        elif m[2]:
            words.append(("literal", int(m[2])))
        elif m[3] in ("true", "false", "none"):
            words.append(("literal", {"true": True, "false": False, "none": None}[m[3]]))
        else:
            words.append(("name", m[3]) if m[3] else ("sign", m[4]))
        at = m.end()
    return words


class _Expression:
    """Recursive descent over the words of one tag: or, and, not, comparison, join, filters, primary."""

    def __init__(self, words: list[tuple[str, Any]]):
        self.words, self.at = words, 0

    def whole(self) -> Node:
        node = self.either()
        if self.at < len(self.words):
            raise TemplateError(f"unexpected {self.words[self.at][1]!r}")
        return node

    def taken(self, *texts: str) -> str | None:
        if self.at < len(self.words) and self.words[self.at][0] != "literal" and self.words[self.at][1] in texts:
            self.at += 1
            return self.words[self.at - 1][1]
        return None

    def either(self) -> Node:
        node = self.both()
        while self.taken("or"):
            node = Node("or", (node, self.both()))
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.taken("and"):
            node = Node("and", (node, self.negated()))
        return node

    def negated(self) -> Node:
        return Node("not", (self.negated(),)) if self.taken("not") else self.compared()

    def compared(self) -> Node:
        node = self.joined()
        while sign := self.taken("==", "!=", "in"):
            node = Node(sign, (node, self.joined()))
        return node

    def joined(self) -> Node:
        node = self.filtered()
        while self.taken("~"):
            node = Node("join", (node, self.filtered()))
        return node

    def filtered(self) -> Node:
        node = self.primary()
        while self.taken("|"):
            name = self.word()
            if name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            more = ()
            if self.taken("("):
                more = (self.either(),)
                if not self.taken(")"):
                    raise TemplateError("missing )")
            node = Node("filter", (name, node, *more))
        return node

    def word(self) -> str:
        if self.at >= len(self.words) or self.words[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return self.words[self.at - 1][1]

    def primary(self) -> Node:
        if self.taken("("):
            node = self.either()
            if not self.taken(")"):
                raise TemplateError("missing )")
        elif self.at < len(self.words) and self.words[self.at][0] == "literal":
            node = Node("literal", (self.words[self.at][1],))
            self.at += 1
        else:
            node = Node("name", (self.word(),))
        while self.taken("."):
            node = Node("field", (node, self.word()))
        return node


def parse(template: str) -> Node:
    """The syntax tree of a template."""
    root: list[Node] = []
    # Each open block: its tag, what it gathers now, what it has gathered (condition, body) so far.
    open_: list[dict] = [{"tag": "", "body": root}]
    at = 0
    for m in _TAG.finditer(template):
        if m.start() > at:
            open_[-1]["body"].append(Node("literal", (template[at : m.start()],)))
        at = m.end()
        if m[1] is not None:
            open_[-1]["body"].append(Node("output", (_Expression(_words(m[1])).whole(),)))
        elif m[2] is not None:
            _statement(_words(m[2]), open_)
    if template[at:]:
        open_[-1]["body"].append(Node("literal", (template[at:],)))
    if len(open_) > 1:
        raise TemplateError(f"{open_[-1]['tag']} is not closed")
    return Node("block", tuple(root))


def _statement(words: list[tuple[str, Any]], open_: list[dict]) -> None:
    tag = words[0][1] if words else ""
    rest, top = _Expression(words[1:]), open_[-1]
    if tag == "if":
        open_.append({"tag": "if", "test": rest.whole(), "arms": [], "body": []})
    elif tag in ("elif", "else") and top["tag"] == "if" and top["test"] is not None:
        top["arms"].append((top["test"], Node("block", tuple(top["body"]))))
        top["test"], top["body"] = (rest.whole() if tag == "elif" else None), []
    elif tag == "endif" and top["tag"] == "if":
        test = top["test"] or Node("literal", (True,))
        arms = (*top["arms"], (test, Node("block", tuple(top["body"]))))
        open_.pop()
        open_[-1]["body"].append(Node("if", arms))
    elif tag == "for":
        name = rest.word()
        if not rest.taken("in"):
            raise TemplateError("for needs in")
        open_.append({"tag": "for", "name": name, "over": rest.whole(), "body": []})
    elif tag == "endfor" and top["tag"] == "for":
        open_.pop()
        open_[-1]["body"].append(Node("for", (top["name"], top["over"], Node("block", tuple(top["body"])))))
    elif tag == "generation":
        open_.append({"tag": "generation", "body": []})
    elif tag == "endgeneration" and top["tag"] == "generation":
        open_.pop()
        open_[-1]["body"].append(Node("generation", (Node("block", tuple(top["body"])),)))
    elif tag == "set" and len(words) > 3 and words[2] == ("sign", "="):
        top["body"].append(Node("set", (words[1][1], _Expression(words[3:]).whole())))
    else:
        raise TemplateError(f"unexpected tag {tag!r}")


# Folding and generating ------------------------------------------------------------------------------------------


def _shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


FILTERS: dict[str, Callable] = {
    "escape": lambda v: escape(_shown(v)),
    "trim": lambda v: _shown(v).strip(),
    "upper": lambda v: _shown(v).upper(),
    "lower": lambda v: _shown(v).lower(),
    "default": lambda v, other="": other if v is None else v,
}
_BINARY: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b if isinstance(b, (str, list, tuple, dict)) else False,
    "join": lambda a, b: _shown(a) + _shown(b),
}


def fold(node: Node) -> Node:
    """The tree with everything computed that depends on no variable."""
    kind, parts = node
    if kind in ("literal", "name"):
        return node
    if kind == "field":
        return Node(kind, (fold(parts[0]), parts[1]))
    if kind == "filter":
        inner = tuple(map(fold, parts[1:]))
        if all(p.kind == "literal" for p in inner):
            return Node("literal", (FILTERS[parts[0]](*[p.parts[0] for p in inner]),))
        return Node(kind, (parts[0], *inner))
    if kind in _BINARY:
        a, b = map(fold, parts)
        if a.kind == b.kind == "literal":
            return Node("literal", (_BINARY[kind](a.parts[0], b.parts[0]),))
        return Node(kind, (a, b))
    if kind == "not":
        inner = fold(parts[0])
        return Node("literal", (not inner.parts[0],)) if inner.kind == "literal" else Node(kind, (inner,))
    if kind in ("and", "or"):
        a, b = map(fold, parts)
        if a.kind == "literal":
            return b if bool(a.parts[0]) == (kind == "and") else a
        return Node(kind, (a, b))
    if kind == "if":
        arms = []
        for test, body in parts:
            test = fold(test)
            if test.kind == "literal" and not test.parts[0]:
                continue
            arms.append((test, fold(body)))
            if test.kind == "literal":
                break
        if arms and arms[0][0].kind == "literal":
            return arms[0][1]
        return Node("if", tuple(arms)) if arms else Node("block", ())
    if kind == "for":
        return Node("for", (parts[0], fold(parts[1]), fold(parts[2])))
    if kind == "set":
        return Node("set", (parts[0], fold(parts[1])))
    if kind == "generation":
        return Node("generation", (fold(parts[0]),))
    if kind == "output":
        inner = fold(parts[0])
        return Node("literal", (_shown(inner.parts[0]),)) if inner.kind == "literal" else Node("output", (inner,))
    flat: list[Node] = []
    for part in map(fold, parts):
        for p in part.parts if part.kind == "block" else (part,):
            if p.kind == "literal" and flat and flat[-1].kind == "literal":
                flat[-1] = Node("literal", (flat[-1].parts[0] + p.parts[0],))
            elif p.kind != "literal" or p.parts[0] != "":
                flat.append(p)
    return Node("block", tuple(flat))


class _Output:
    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def _value(node: Node) -> Callable[[dict], Any]:
    kind, parts = node
    if kind == "literal":
        return lambda env, v=parts[0]: v
    if kind == "name":
        return lambda env, n=parts[0]: env.get(n)
    if kind == "field":
        inner = _value(parts[0])

        def field(env: dict, n: str = parts[1]) -> Any:
            held = inner(env)
            return held.get(n) if isinstance(held, dict) else None

        return field
    if kind == "filter":
        apply, inputs = FILTERS[parts[0]], [_value(p) for p in parts[1:]]
        return lambda env: apply(*[f(env) for f in inputs])
    if kind == "not":
        inner = _value(parts[0])
        return lambda env: not inner(env)
    a, b = _value(parts[0]), _value(parts[1])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    return lambda env, op=_BINARY[kind]: op(a(env), b(env))


def _writer(node: Node) -> Callable[[dict, _Output], None]:
    kind, parts = node
    if kind == "literal":
        return lambda env, out, t=_shown(parts[0]): out.write(t)
    if kind == "output":
        value = _value(parts[0])
        return lambda env, out: out.write(_shown(value(env)))
    if kind == "set":
        value = _value(parts[1])
        return lambda env, out, n=parts[0]: env.__setitem__(n, value(env))
    if kind == "if":
        arms = [(_value(test), _writer(body)) for test, body in parts]

        def choose(env: dict, out: _Output) -> None:
            for test, body in arms:
                if test(env):
                    return body(env, out)

        return choose
    if kind == "for":
        over, body = _value(parts[1]), _writer(parts[2])

        def repeat(env: dict, out: _Output, n: str = parts[0]) -> None:
            for item in over(env) or ():
                body({**env, n: item}, out)

        return repeat
    if kind == "generation":
        body = _writer(parts[0])

        def mark(env: dict, out: _Output) -> None:
            start = out.length
            body(env, out)
            out.spans.append((start, out.length))

        return mark
    steps = [_writer(p) for p in parts]

    def run(env: dict, out: _Output) -> None:
        for step in steps:
            step(env, out)

    return run


def compile_template(template: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages (role, text) to the formatted text and its training spans (start, end)."""
    write = _writer(fold(parse(template)))

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        write({"messages": messages}, out)
        return "".join(out.pieces), out.spans

    return render


# Reading back ------------------------------------------------------------------------------------------------------

_TURN = re.compile(
    r"\[SYS\] (?P<system>.*?) \[/SYS\]\n|\[INST\] (?P<user>.*?) \[/INST\]\n|<s>(?P<assistant>.*?)</s>\n"
    r"|\[ROLE\](?P<role>.*?)\[/ROLE\](?P<text>.*?)\[END\]\n",
    re.DOTALL,
)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of what ``TEMPLATE`` has formatted."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        kind = m.lastgroup
        role, text = (unescape(m["role"]), m["text"]) if kind == "text" else (kind, m[kind])
        turns.append((role, unescape(text)))
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return turns


def read_loss(formatted: str, spans: Iterable[tuple[int, int]]) -> str:
    """All text under the loss mask, unescaped."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)


# Conversations -----------------------------------------------------------------------------------------------------


def format_conversations(
    df: DataFrame,
    template: str = TEMPLATE,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: its id, n_rows, formatted text, and loss_starts and loss_ends (arrays of offsets).

    Turns are ordered by turn (null first), then role and text. Null roles and texts are empty. Rows without an id form
    one conversation. Conversations are dealt to tasks by id and read in order, one at a time.
    """
    ship(df.sparkSession)
    work = df.select(
        col(conv_col).alias("conv"),
        col(turn_col).alias("turn"),
        F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    id_type = work.schema["conv"].dataType.simpleString()
    dealt = work.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").drop("turn")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render, held, rows = compile_template(template), None, []

        def close() -> None:
            formatted, spans = render(held[1])
            rows.append((held[0], len(held[1]), formatted, [a for a, _ in spans], [b for _, b in spans]))

        kind = None
        for batch in batches:
            kind = batch.schema.field("conv").type
            for conv, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "role", "text")], strict=True):
                if held is None or held[0] != conv:
                    if held is not None:
                        close()
                    held = (conv, [])
                held[1].append({"role": role, "text": text})
            yield _conversations(rows, kind)
            rows.clear()
        if held is not None:
            close()
            yield _conversations(rows, kind)

    schema = f"conv {id_type}, n_rows bigint, formatted string, loss_starts array<bigint>, loss_ends array<bigint>"
    return dealt.mapInArrow(run, schema).withColumnRenamed("conv", conv_col)


def _conversations(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    offsets = pa.list_(pa.int64())
    types = [id_type, pa.int64(), pa.string(), offsets, offsets]
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["conv", "n_rows", "formatted", "loss_starts", "loss_ends"])


def conversation_digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What can be read back from formatted conversations: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars. Only the formatted text and its spans are used."""
    id_type = formatted.schema[conv_col].dataType.simpleString()
    work = formatted.select(col(conv_col).alias("conv"), "formatted", "loss_starts", "loss_ends")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("formatted", "loss_starts", "loss_ends")]
            for text, starts, ends in zip(*columns, strict=True):
                turns = read_turns(text)
                told = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                loss = read_loss(text, zip(starts, ends, strict=True))
                rows.append((len(turns), told, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, types, strict=True)]
            names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *arrays], names)

    schema = f"conv {id_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return work.mapInArrow(run, schema).withColumnRenamed("conv", conv_col)
