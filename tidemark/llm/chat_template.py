"""Chat formatting by a template compiler (operator 3).

A small sandboxed template language is parsed into a syntax tree, constants
are folded, and the tree is turned into Python closures.

Language: text, ``{{ expression }}``, ``{# comment #}`` and the blocks ``if /
elif / else / endif``, ``for x in e / endfor`` (with ``loop.index``,
``index0``, ``first``, ``last``), ``set x = e`` and ``generation /
endgeneration``, whose output is marked as model text.  A ``-`` inside a
tag's border trims the white space next to it.  Expressions: literals, lists,
names, ``a.b`` and ``a['b']`` on mappings, ``a[i]`` on lists, arithmetic,
``~`` (join as text), comparisons, ``in``, ``and / or / not``, filters.  There
are no calls, no attributes of Python objects and no names with a leading
underscore, so a template reaches nothing but the values it is given.

Rendering is a stream of (text, is model text) pieces: a conversation of any
length passes turn by turn.  ``read_back`` parses the formatted text again.

Defined results: a null text or role is empty; rows tying on turn are ordered
by role and text; a null conv_id is one conversation; an empty table gives no
rows.  A conversation's digest is one sequential hash, so its rows meet in
one task, which streams them and holds one turn at a time.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches


class TemplateError(ValueError):
    pass


# --- syntax tree ---------------------------------------------------------------------------------


@dataclass
class Const:
    value: object


@dataclass
class Name:
    name: str


@dataclass
class Item:
    base: object
    key: object


@dataclass
class Apply:
    """A pure operation on values: operator, comparison, list or filter."""

    op: str
    args: list


@dataclass
class Choice:
    """``and`` / ``or``: the right side is looked at only when it decides."""

    op: str
    left: object
    right: object


@dataclass
class Put:
    value: object


@dataclass
class If:
    test: object
    then: list
    other: list


@dataclass
class For:
    name: str
    over: object
    body: list


@dataclass
class Set:
    name: str
    value: object


@dataclass
class Generation:
    body: list


# --- control strings -----------------------------------------------------------------------------

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[/TURN]")
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROLS)
_PLAIN = re.compile(rf"([<\[])(\\*)({_TAILS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_TAILS})")


def escape(text: str) -> str:
    """One more backslash after the first character of every control string:
    none is left, and ``unescape`` gives the text back."""
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _text(v) -> str:
    if v is None:
        return ""
    if v is True or v is False:
        return "true" if v else "false"
    return str(v)


FILTERS: dict[str, Callable] = {
    "escape": lambda v: escape(_text(v)), "trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(), "length": len, "string": _text,
    "replace": lambda v, a, b: _text(v).replace(a, b), "join": lambda v, sep="": sep.join(map(_text, v)),
    "default": lambda v, d: d if v is None else v,
}


def _add(a, b):
    return a + b if isinstance(a, (int, float)) and isinstance(b, (int, float)) else _text(a) + _text(b)


PURE: dict[str, Callable] = {
    "+": _add, "-": operator.sub, "*": operator.mul, "/": operator.truediv, "%": operator.mod, "neg": operator.neg,
    "~": lambda a, b: _text(a) + _text(b), "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le,
    ">": operator.gt, ">=": operator.ge, "in": lambda a, b: a in b, "not in": lambda a, b: a not in b,
    "not": operator.not_, "list": lambda *v: list(v), **{f"|{k}": f for k, f in FILTERS.items()},
}

# --- parsing -------------------------------------------------------------------------------------

_TAG = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_LEX = re.compile(r"""\s*(?:(\d+\.\d+|\d+)|('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|([A-Za-z]\w*)|(==|!=|<=|>=|[-+*/%~<>()\[\].,|=]))""", re.S)
_WORDS = {"and", "or", "not", "in", "true", "false", "none", "if", "else", "elif", "for", "set"}
_QUOTED = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}


def _lex(src: str) -> list[tuple[str, object]]:
    out, at = [], 0
    src = src.rstrip()
    while at < len(src):
        m = _LEX.match(src, at)
        if not m:
            raise TemplateError(f"cannot read {src[at:]!r}")
        num, quoted, word, sign = m.groups()
        if num:
            out.append(("value", float(num) if "." in num else int(num)))
        elif quoted:
            out.append(("value", re.sub(r"\\(.)", lambda k: _QUOTED.get(k[1], k[0]), quoted[1:-1], flags=re.S)))
        elif word:
            low = word.lower()
            if low in ("true", "false", "none"):
                out.append(("value", {"true": True, "false": False, "none": None}[low]))
            else:
                out.append(("word" if word in _WORDS else "name", word))
        else:
            out.append(("sign", sign))
        at = m.end()
    return out


class _Expression:
    """Recursive descent over one tag's tokens."""

    def __init__(self, tokens):
        self.tokens, self.at = tokens, 0

    def peek(self, *values) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "value" and self.tokens[self.at][1] in values

    def take(self, *values):
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value):
        if not self.take(value):
            raise TemplateError(f"{value!r} expected")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("name expected")

    def done(self, node):
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def expr(self):
        return self._choice(0)

    def _choice(self, level):
        if level == 2:
            return self._not()
        word = ("or", "and")[level]
        node = self._choice(level + 1)
        while self.take(word):
            node = Choice(word, node, self._choice(level + 1))
        return node

    def _not(self):
        return Apply("not", [self._not()]) if self.take("not") else self._compare()

    def _compare(self):
        node = self._sum()
        while True:
            op = self.take("==", "!=", "<", "<=", ">", ">=", "in")
            if not op and self.peek("not"):
                self.at += 1
                self.need("in")
                op = "not in"
            if not op:
                return node
            node = Apply(op, [node, self._sum()])

    def _sum(self):
        node = self._product()
        while op := self.take("+", "-", "~"):
            node = Apply(op, [node, self._product()])
        return node

    def _product(self):
        node = self._unary()
        while op := self.take("*", "/", "%"):
            node = Apply(op, [node, self._unary()])
        return node

    def _unary(self):
        return Apply("neg", [self._unary()]) if self.take("-") else self._postfix()

    def _postfix(self):
        node = self._atom()
        while True:
            if self.take("."):
                node = Item(node, Const(self.name()))
            elif self.take("["):
                node = Item(node, self.expr())
                self.need("]")
            elif self.take("|"):
                name, args = self.name(), [node]
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                if self.take("("):
                    args += self._list(")")
                node = Apply(f"|{name}", args)
            else:
                return node

    def _list(self, end):
        out = []
        while not self.take(end):
            out.append(self.expr())
            if not self.peek(end):
                self.need(",")
        return out

    def _atom(self):
        if self.take("("):
            node = self.expr()
            self.need(")")
            return node
        if self.take("["):
            return Apply("list", self._list("]"))
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "value":
            self.at += 1
            return Const(self.tokens[self.at - 1][1])
        return Name(self.name())


def _pieces(source: str) -> Iterator[tuple[str, str]]:
    """(kind, content): kind is text, put or block; trimming marks are applied."""
    at, trim = 0, False
    for m in _TAG.finditer(source):
        text = source[at: m.start()]
        if trim:
            text = text.lstrip()
        raw = m.group()
        if raw[2:3] == "-":
            text = text.rstrip()
        if text:
            yield "text", text
        if m[1] is not None:
            yield "put", m[1]
        elif m[2] is not None:
            yield "block", m[2]
        at, trim = m.end(), raw[-3:-2] == "-" and raw[1] != "#"
    text = source[at:].lstrip() if trim else source[at:]
    if text:
        yield "text", text


def parse(source: str) -> list:
    """Syntax tree of a template: a list of nodes."""
    root: list = []
    open_blocks: list[tuple[str, object]] = []
    body = root
    for kind, content in _pieces(source):
        if kind == "text":
            body.append(Put(Const(content)))
            continue
        e = _Expression(_lex(content))
        if kind == "put":
            body.append(Put(e.done(e.expr())))
            continue
        word = e.tokens[0][1] if e.tokens else ""
        e.at = 1
        if word == "if":
            node = If(e.done(e.expr()), [], [])
            body.append(node)
            open_blocks.append(("if", node, body))
            body = node.then
        elif word in ("elif", "else"):
            if not open_blocks or open_blocks[-1][0] != "if":
                raise TemplateError(f"{word} outside an if")
            node = open_blocks[-1][1]
            if word == "else":
                body = e.done(node).other
            else:
                inner = If(e.done(e.expr()), [], [])
                node.other.append(inner)
                open_blocks[-1] = ("if", inner, open_blocks[-1][2])
                body = inner.then
        elif word == "for":
            name = e.name()
            e.need("in")
            node = For(name, e.done(e.expr()), [])
            body.append(node)
            open_blocks.append(("for", node, body))
            body = node.body
        elif word == "generation":
            node = e.done(Generation([]))
            body.append(node)
            open_blocks.append(("generation", node, body))
            body = node.body
        elif word == "set":
            name = e.name()
            e.need("=")
            body.append(Set(name, e.done(e.expr())))
        elif word in ("endif", "endfor", "endgeneration"):
            if not open_blocks or f"end{open_blocks[-1][0]}" != word:
                raise TemplateError(f"{word} closes nothing")
            body = e.done(open_blocks.pop())[2]
        else:
            raise TemplateError(f"unknown block {word!r}")
    if open_blocks:
        raise TemplateError(f"{open_blocks[-1][0]} is not closed")
    return root


# --- folding -------------------------------------------------------------------------------------


def fold(node):
    """Evaluate what depends on constants only; drop branches that are never taken; merge adjacent text."""
    if isinstance(node, list):
        out: list = []
        for x in map(fold, node):
            for y in x if isinstance(x, list) else [x]:
                if isinstance(y, Put) and isinstance(y.value, Const):
                    text = _text(y.value.value)
                    if not text:
                        continue
                    if out and isinstance(out[-1], Put) and isinstance(out[-1].value, Const):
                        out[-1] = Put(Const(out[-1].value.value + text))
                        continue
                    y = Put(Const(text))
                out.append(y)
        return out
    if isinstance(node, Apply):
        args = [fold(a) for a in node.args]
        if all(isinstance(a, Const) for a in args):
            return Const(PURE[node.op](*[a.value for a in args]))
        return Apply(node.op, args)
    if isinstance(node, Choice):
        left, right = fold(node.left), fold(node.right)
        if isinstance(left, Const):
            return right if bool(left.value) == (node.op == "and") else left
        return Choice(node.op, left, right)
    if isinstance(node, Item):
        base, key = fold(node.base), fold(node.key)
        return Item(base, key)
    if isinstance(node, Put):
        return Put(fold(node.value))
    if isinstance(node, If):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.other)
        return If(test, fold(node.then), fold(node.other))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Set):
        return Set(node.name, fold(node.value))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    return node


# --- closures ------------------------------------------------------------------------------------


def _item(base, key):
    """The sandbox's only access: keys of mappings, positions of lists."""
    if isinstance(base, dict):
        return base.get(key)
    if isinstance(base, (list, tuple)) and isinstance(key, int):
        return base[key] if -len(base) <= key < len(base) else None
    return None


def _value(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        v = node.value
        return lambda env: v
    if isinstance(node, Name):
        name = node.name
        return lambda env: env.get(name)
    if isinstance(node, Item):
        base, key = _value(node.base), _value(node.key)
        return lambda env: _item(base(env), key(env))
    if isinstance(node, Choice):
        left, right = _value(node.left), _value(node.right)
        if node.op == "and":
            return lambda env: left(env) and right(env)
        return lambda env: left(env) or right(env)
    f, args = PURE[node.op], [_value(a) for a in node.args]
    if len(args) == 1:
        a = args[0]
        return lambda env: f(a(env))
    if len(args) == 2:
        a, b = args
        return lambda env: f(a(env), b(env))
    return lambda env: f(*[a(env) for a in args])


def _with_next(items) -> Iterator[tuple[object, bool]]:
    it = iter(items)
    for item in it:
        for following in it:
            yield item, False
            item = following
        yield item, True


def _body(nodes: list, marked: bool, top: bool = False) -> Callable[[dict], Iterator]:
    steps = [_step(n, marked, top) for n in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(env):
        for s in steps:
            yield from s(env)

    return run


def _step(node, marked: bool, top: bool) -> Callable[[dict], Iterator]:
    if isinstance(node, Put):
        if isinstance(node.value, Const):
            pair = (node.value.value, marked)
            return lambda env: iter((pair,))
        value = _value(node.value)
        return lambda env: iter(((_text(value(env)), marked),))
    if isinstance(node, If):
        test, then, other = _value(node.test), _body(node.then, marked), _body(node.other, marked)
        return lambda env: then(env) if test(env) else other(env)
    if isinstance(node, Generation):
        return _body(node.body, True)
    if isinstance(node, Set):
        name, value = node.name, _value(node.value)

        def put(env):
            env[name] = value(env)
            return iter(())

        return put
    over, body, name = _value(node.over), _body(node.body, marked), node.name
    turns = top and isinstance(node.over, Name) and node.over.name == "messages"

    def loop(env):
        for i, (item, last) in enumerate(_with_next(over(env) or ())):
            inner = {**env, name: item, "loop": {"index": i + 1, "index0": i, "first": i == 0, "last": last}}
            yield from body(inner)
            if turns:
                yield None  # a turn ends here

    return loop


class Template:
    def __init__(self, source: str):
        self.tree = fold(parse(source))
        self._run = _body(self.tree, False, top=True)

    def stream(self, **values) -> Iterator[tuple[str, bool] | None]:
        """Pieces (text, is model text); None where a turn of ``messages`` ends."""
        return self._run(dict(values))

    def render(self, **values) -> tuple[str, list[tuple[int, int]]]:
        """Formatted text and the spans of model text in it, in code points."""
        parts, spans, at = [], [], 0
        for piece in self.stream(**values):
            if piece and piece[0]:
                parts.append(piece[0])
                if piece[1]:
                    spans.append((at, at + len(piece[0])))
                at += len(piece[0])
        return "".join(parts), spans


TEMPLATE = """
{%- set close_user = ' ' ~ '[/INST]' -%}
{%- for message in messages -%}
{%- if loop.first -%}<s>{%- endif -%}
{%- if message.role == 'user' -%}{{ '[INST] ' }}{{ message.text | escape }}{{ close_user }}
{%- elif message.role == 'assistant' -%}{% generation %}{{ message.text | escape }}{% endgeneration %}{{ '</s>' }}
{%- else -%}{{ '[ROLE]' ~ (message.role | escape) ~ '[/ROLE] ' }}{{ message.text | escape }}{{ ' [/TURN]' }}
{%- endif -%}
{%- endfor -%}
"""

_TURN = re.compile(r"(?:<s>)?(?:\[INST\] (?P<user>.*?) \[/INST\]|\[ROLE\](?P<role>.*?)\[/ROLE\] (?P<other>.*?) \[/TURN\]|(?P<assistant>.*?)</s>)", re.S)


def read_turn(text: str) -> tuple[str, str]:
    """(role, text) of one formatted turn, unescaped."""
    m = _TURN.fullmatch(text)
    if m is None:
        raise ValueError("not a formatted turn")
    if m["user"] is not None:
        return "user", unescape(m["user"])
    if m["assistant"] is not None:
        return "assistant", unescape(m["assistant"])
    return unescape(m["role"]), unescape(m["other"])


# --- Spark ---------------------------------------------------------------------------------------


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    """(conv_id, its messages in order), read from sorted batches one row at a time."""
    rows = ((c, {"role": r or "", "text": t or ""}) for b in batches
            for c, r, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()))
    held = next(rows, None)

    def messages(conv_id):
        nonlocal held
        while held is not None and held[0] == conv_id:
            now, held = held[1], next(rows, None)
            yield now

    while held is not None:
        conv_id = held[0]
        mine = messages(conv_id)
        yield conv_id, mine
        for _ in mine:  # a template may leave messages unread
            pass


_TURN_SCHEMA = "conv_id long, part long, formatted string, spans array<struct<start:long,end:long>>"
FLUSH_ROWS = 256


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per turn of each conversation: conv_id, part (order in the
    conversation), formatted text and the spans of model text (code points
    from the conversation's start).  The parts in order are the formatted
    conversation; they lie in order in one partition."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled, out = Template(template), []
        for conv_id, messages in _conversations(batches):
            at, part, text, spans = 0, 0, [], []
            for piece in compiled.stream(messages=messages):
                if piece is not None:
                    if piece[0]:
                        text.append(piece[0])
                        if piece[1]:
                            spans.append({"start": at, "end": at + len(piece[0])})
                        at += len(piece[0])
                    continue
                out.append((conv_id, part, "".join(text), spans))
                part, text, spans = part + 1, [], []
                if len(out) >= FLUSH_ROWS:
                    yield _turn_batch(out)
                    out = []
            if text:
                out.append((conv_id, part, "".join(text), spans))
        yield _turn_batch(out)

    ordered = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "role", "text", "turn").repartition(
        F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, _TURN_SCHEMA)


def _turn_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
    cols = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["conv_id", "part", "formatted", "spans"])


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, computed from the formatted parts alone.
    The input keeps the order that ``format_conversations`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for b in batches:
            for conv_id, text, spans in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if now is None or now[0] != conv_id:
                    if now is not None:
                        out.append(_digest(now))
                    now = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = read_turn(text)
                now[1] += 1
                now[2].update(f"{role}\n{said}\n".encode("utf-8"))
                for s in spans:
                    model = unescape(text[s["start"] - now[5]: s["end"] - now[5]])
                    now[3] += len(model)
                    now[4].update(model.encode("utf-8"))
                now[5] += len(text)
            yield _digest_batch(out)
            out = []
        if now is not None:
            yield _digest_batch([_digest(now)])

    return formatted.mapInArrow(run, _DIGEST)


def _digest(s: list) -> tuple:
    return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    cols = list(zip(*rows)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
