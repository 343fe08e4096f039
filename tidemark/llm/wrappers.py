"""HTML main text by inferred wrappers (operator 9).

A wrapper is a union-free regular expression over the tokens of a host's
pages: tags as they are, text slots, optional groups ``(...)?`` and repeated
groups ``(...)+``.

1. Each page becomes a token stream; tandem repeats fold into repeated
   groups.  Pages of a host mostly share one folded form, so distinct forms
   are counted first (partial aggregates): a host with a third of all pages
   leaves a task as a handful of forms.
2. The forms of a host are aligned, two by two, into one wrapper: equal
   parts stay; a part that one side lacks becomes an optional group; groups
   that repeat the same thing become one repeated group.  Forms are merged
   in bundles of ``FAN_IN``, then bundles of bundles, so a host with very many
   forms is never merged in one task.
3. Each slot of the wrapper is labelled by the tags around it: main text is
   what lies in the article (or ``main`` element; the body of a page that has
   neither) outside menus, headers, footers, sidebars, notices, adverts,
   forms, comments (also articles in an article), scripts and styles.  The
   labels are part of the page's own tokens, so these rules alone decide which
   texts are taken: the wrapper that a page matches does not change its row.
4. Every page is matched with its host's wrapper and the texts of the main
   slots are taken, block by block.  A host's wrapper goes to ``SALTS``
   groups of its pages, so a large host's pages spread over many tasks.

A wrapper is run as an automaton whose states are made when a page asks for
them: every page is matched to its end, in time linear in its tokens whatever
the wrapper, without a search, a time limit or a clock.  A page that does not
match its host's wrapper is read by its own form (a wrapper that it matches by
construction, token by token): no page loses text, however long it is.

White space inside a block becomes one space, blocks are joined by one space.

Defined results: a null or empty html gives an empty text; a null url is a
host of its own; repeated rows are extracted each; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import json
import re
import time
from bisect import bisect_left
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import small_batches, staged

FAN_IN = 64
SALTS = 32
MAX_PERIOD = 24  # longest token run that is folded as a repeat at one level
MATCH_SECONDS: float | None = None  # no limit: every page is matched to its end
HELD = 1 << 16  # positions in the states that one wrapper keeps; beyond, they are made anew

SLOT = "#"

# Fixed values of HTML: elements whose content is no markup, elements without an end tag, inline elements
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp "
                    "small span strike strong sub sup time tt u var wbr").split())
#: elements that never hold main text
SIDE_TAGS = frozenset(("head script style noscript template nav header footer aside form button select textarea iframe "
                       "svg title menu dialog").split())
#: words of a class or id that mark side matter
SIDE_WORDS = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumb\w*|header|footer|sidebar|side|related|"
    r"notice\w*|cookie\w*|consent|popup|modal|alert|comment\w*|repl(?:y|ies)|disqus|share|social|subscribe|newsletter|login|search)(?:[^a-z]|$)")
MAIN_TAGS = ("article", "main")
#: a stray end tag does not reach beyond the nearest of these
REGIONS = frozenset(("html body article main nav header footer aside section div form table ul ol").split())

# a tag ends at the first '>' outside a value quoted right after '='; a stray quote quotes nothing (the look-ahead is never re-read)
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/>]*)(?=((?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*)|[^>])*))\3>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


SIDE, MAIN, BODY = "s:", "m:", "b:"


class _Open:
    """Open elements while a page is read, each with its label."""

    def __init__(self):
        self.names: list[str] = []
        self.labels: list[str] = [BODY]

    def start(self, name: str, marks: str) -> str:
        if name == "p" and self.names[-1:] == ["p"]:
            self.end("p")
        label = self.labels[-1]
        if label != SIDE:
            nested = name == "article" and "article" in self.names  # by the HTML standard a comment on the outer one
            if nested or name in SIDE_TAGS or (name not in ("html", "body", *MAIN_TAGS) and SIDE_WORDS.search(marks)):
                label = SIDE
            elif name in MAIN_TAGS:
                label = MAIN
        if name not in VOID:
            self.names.append(name)
            self.labels.append(label)
        return label

    def end(self, name: str) -> str:
        """An end tag closes the nearest open element of its name; one that closes nothing is kept as it is."""
        for i in range(len(self.names) - 1, -1, -1):
            if self.names[i] == name:
                label = self.labels[i + 1]
                del self.names[i:], self.labels[i + 1:]
                return label
            if self.names[i] in REGIONS and name not in REGIONS:  # a stray inline or block end does not close a region
                break
        return self.labels[-1]


def tokens(page: str) -> list[tuple[str, str]]:
    """(token, text).  A tag's token is its name with class, id and role; a
    text is a slot with its raw characters.  Every token carries its label:
    side matter, inside an article or main element, or other body."""
    out: list[tuple[str, str]] = []
    stack, at, n = _Open(), 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        raw = m.group()
        name = m[2]
        if name is None:
            if raw.startswith(("<!", "<?")):
                continue
            slot = stack.labels[-1] + SLOT
            if out and out[-1][0] == slot:
                out[-1] = (slot, out[-1][1] + raw)
            else:
                out.append((slot, raw))
            continue
        name = name.lower()
        if m[1]:
            out.append((f"{stack.end(name)}/{name}", ""))
            continue
        marks = " ".join(f"{k.lower()}={(a or b or c).lower()}" for k, a, b, c in _ATTRIBUTE.findall(m[3]))
        label = stack.start(name, marks)
        out.append((f"{label}{name} {marks}" if marks else label + name, ""))
        if name in RAW and not m[3].rstrip().endswith("/"):
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            stop = end.start() if end else n
            if stop > at:
                out.append((label + SLOT, page[at:stop]))
            out.append((f"{stack.end(name)}/{name}", ""))
            at = end.end() if end else n
    return [t for t in out if t[0][2:] != SLOT or t[1].strip()]


# --- wrapper expressions -------------------------------------------------------------------------
# A wrapper is a list of nodes: a token (str), ["+", nodes] for one or more, ["?", nodes] for none or one.


def _key(node) -> str:
    return node if isinstance(node, str) else json.dumps(node, separators=(",", ":"))


def _bare(node) -> str:
    """What has to be equal for two nodes to align: a token, or the first token that a group repeats."""
    if isinstance(node, str):
        return node
    return node[0] + _bare(node[1][0])


def fold(nodes: list) -> list:
    """Fold tandem repeats into groups, shortest period first, until none is left."""
    changed = True
    while changed:
        changed = False
        for period in range(1, min(MAX_PERIOD, len(nodes) // 2 + 1) + 1):
            out, i, hit = [], 0, False
            keys = [_key(x) for x in nodes]
            while i < len(nodes):
                j = i + period
                if period == 1 and not isinstance(nodes[i], str) and nodes[i][0] == "+":
                    while j < len(nodes) and keys[j] == keys[i]:  # adjacent equal groups are one
                        j += 1
                    out.append(nodes[i])
                    hit = hit or j > i + 1
                    i = j
                    continue
                run = keys[i: i + period]
                while len(run) == period and keys[j: j + period] == run:
                    j += period
                if j > i + period:
                    out.append(["+", nodes[i: i + period]])
                    hit, i = True, j
                else:
                    out.append(nodes[i])
                    i += 1
            nodes = _absorb(out) if hit else out
            if hit:
                changed = True
                break
    return nodes


def _absorb(nodes: list) -> list:
    """A group next to one more occurrence of what it repeats takes it in."""
    out: list = []
    for x in nodes:
        out.append(x)
        while len(out) > 1:
            if not isinstance(out[-1], str) and out[-1][0] == "+":
                body = out[-1][1]
                n = len(body)
                if out[-1 - n: -1] == body and n:
                    del out[-1 - n: -1]
                    continue
            for back in range(2, min(MAX_PERIOD, len(out)) + 1):
                g = out[-back]
                if not isinstance(g, str) and g[0] == "+" and out[1 - back:] == g[1]:
                    del out[1 - back:]
                    break
            else:
                break
    return out


def _flat(nodes: list) -> list[tuple]:
    """(token or repeated group, optional group that it belongs to or None), optional groups opened."""
    out = []
    for i, x in enumerate(nodes):
        if not isinstance(x, str) and x[0] == "?":
            out += [(y, (i, g)) for y, g in _flat(x[1])]
        else:
            out.append((x, None))
    return out


def _grouped(items: list[tuple]) -> list:
    """Neighbours of one optional group are put into it again."""
    out: list = []
    last = None
    for x, g in items:
        if g is None:
            out.append(x)
        elif g == last:
            out[-1][1].append(x)
        else:
            out.append(["?", [x]])
        last = g
    return out


def align(a: list, b: list) -> list:
    """One expression that accepts what ``a`` and what ``b`` accept."""
    if a == b:
        return a
    fa, fb = _flat(a), _flat(b)
    out: list[tuple] = []
    codes = SequenceMatcher(None, [_bare(x) for x, _ in fa], [_bare(x) for x, _ in fb], autojunk=False).get_opcodes()
    for n, (op, a0, a1, b0, b1) in enumerate(codes):
        if op == "equal":
            for (x, g), (y, h) in zip(fa[a0:a1], fb[b0:b1]):
                node = x if isinstance(x, str) else ["+", align(x[1], y[1])]
                out.append((node, None if g is None and h is None else ("both", g, h)))
        else:
            out += _mismatch(fa[a0:a1], fb[b0:b1], n)
    return _grouped(out)


def _mismatch(a: list[tuple], b: list[tuple], n: int) -> list[tuple]:
    """Two runs that differ.  If one is a repeated group and the other holds
    an occurrence of what it repeats, the group stays, with the occurrence's own
    optional groups inside, and what surrounds the occurrence is optional;
    otherwise each run is an optional group."""
    for x, y in ((a, b), (b, a)):
        if len(x) == 1 and not isinstance(x[0][0], str):
            body, keys = [_bare(z) for z in x[0][0][1]], [_bare(z) for z, _ in y]
            for i in range(len(keys) - len(body) + 1):
                if keys[i: i + len(body)] == body:
                    taken = y[i: i + len(body)]
                    free = x[0][1] is None and all(g is None for _, g in taken)
                    group = ["+", align(x[0][0][1], _grouped(taken))]
                    return ([(z, ("before", n, g)) for z, g in y[:i]] + [(group, None if free else ("group", n))]
                            + [(z, ("after", n, g)) for z, g in y[i + len(body):]])
    return [(z, ("left", n, g)) for z, g in a] + [(z, ("right", n, g)) for z, g in b]


class _Sequence:
    """Nodes that follow one another: a wrapper, or what one of its groups holds.

    A segment is a run of nodes that may be absent, with the first one after
    them that may not.  ``index`` has, per segment, the positions that can come
    first by token; ``open`` says whether a segment reaches the sequence's end."""

    __slots__ = ("up", "at", "repeats", "starts", "segment", "index", "open")

    def __init__(self, up: "_Sequence | None", at: int, repeats: bool):
        self.up, self.at, self.repeats = up, at, repeats
        self.starts: list[int] = []  # the first position of each node
        self.segment: list[int] = []
        self.index: list[dict[str, list[int]]] = []
        self.open: list[bool] = []

    def add(self, start: int, firsts: dict[str, list[int]], empty: bool) -> None:
        if not self.open or not self.open[-1]:
            self.index.append({})
            self.open.append(True)
        self.starts.append(start)
        self.segment.append(len(self.index) - 1)
        for token, at in firsts.items():
            self.index[-1].setdefault(token, []).extend(at)
        self.open[-1] = empty

    def firsts(self) -> dict[str, list[int]]:
        return self.index[0] if self.index else {}

    def empty(self) -> bool:
        return not self.open or self.open[0]


class Wrapper:
    """A wrapper as an automaton.  Its positions are the wrapper's tokens in
    order; a state is the positions that the page's last token may have, all of
    that token.  States and steps are made when a page asks for them and kept for others."""

    def __init__(self, nodes: list):
        self.tokens: list[str] = []
        self.places: list[tuple[_Sequence, int]] = []
        self.top = self._build(nodes, None, 0, False)
        self._forget()

    def _build(self, nodes: list, up: _Sequence | None, at: int, repeats: bool) -> _Sequence:
        seq = _Sequence(up, at, repeats)
        for i, x in enumerate(nodes):
            start = len(self.tokens)
            if isinstance(x, str):
                self.tokens.append(x)
                self.places.append((seq, i))
                seq.add(start, {x: [start]}, False)
            else:
                inner = self._build(x[1], seq, i, x[0] == "+")
                seq.add(start, inner.firsts(), x[0] == "?" or inner.empty())
        return seq

    def _forget(self) -> None:
        self.states: list[tuple[int, ...]] = []
        self.steps: list[dict[str, int | None]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.held = 0

    def _number(self, state: tuple[int, ...]) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
            self.held += len(state)
        return self.numbers[state]

    def _after(self, state: tuple[int, ...], token: str | None) -> tuple[int, ...]:
        """Positions of the token that can follow a position of the state (-1: the start); for None, (-1,) if the wrapper can end there."""
        found, seen = set(), set()
        for p in state:
            seq, i = (self.top, 0) if p < 0 else (self.places[p][0], self.places[p][1] + 1)
            while seq is not None and (seq, i) not in seen:
                seen.add((seq, i))
                if i < len(seq.starts):
                    at = seq.index[seq.segment[i]].get(token, [])
                    found.update(at[bisect_left(at, seq.starts[i]):])
                    if not seq.open[seq.segment[i]]:
                        break
                if seq.repeats:
                    found.update(seq.firsts().get(token, []))
                seq, i = seq.up, seq.at + 1
            if seq is None and token is None:
                return (-1,)
        return tuple(sorted(found))

    def _step(self, state: int, token: str | None) -> int | None:
        """The state after the token, None if there is none."""
        now = self.states[state]
        after = self._after(now, token)
        if self.held > HELD:
            self._forget()
            state = self._number(now)
        self.held += 1
        to = self.steps[state][token] = self._number(after) if after else None
        return to

    def main_slots(self, stream: list[tuple[str, str]]) -> list[int] | None:
        """Positions of the stream's main texts: those whose slot in the wrapper is labelled so.  None if the page
        does not match (or, only if ``MATCH_SECONDS`` is set, not within that time)."""
        until = None if MATCH_SECONDS is None else time.monotonic() + MATCH_SECONDS
        wanted, chosen, now = wanted_label(stream) + SLOT, [], self._number((-1,))
        for i, token in enumerate([*(t for t, _ in stream), None]):
            steps = self.steps[now]
            now = steps[token] if token in steps else self._step(now, token)
            if now is None or until is not None and time.monotonic() > until:
                return None
            if token is not None and self.tokens[self.states[now][0]] == wanted:
                chosen.append(i)
        return chosen


def wanted_label(stream: list[tuple[str, str]]) -> str:
    return MAIN if any(t[0] == MAIN[0] for t, _ in stream) else BODY


def own_slots(stream: list[tuple[str, str]]) -> list[int]:
    """Positions of the main texts by the page's own form: unfolded it has one
    node per token, so node i matches token i."""
    wanted = wanted_label(stream)
    return [i for i, (t, _) in enumerate(stream) if t == wanted + SLOT]


def blocks(stream: list[tuple[str, str]], chosen: list[int]) -> str:
    """Text of the chosen slots: inline tags join, all others end a block."""
    wanted, out, now = set(chosen), [], []

    def close():
        text = " ".join("".join(now).split())
        if text:
            out.append(text)
        now.clear()

    for i, (token, raw) in enumerate(stream):
        if token[2:] == SLOT:
            if i in wanted:
                now.append(entities.unescape(raw))
            else:
                close()
        elif token[2:].lstrip("/").split(" ")[0] not in INLINE:
            close()
    close()
    return " ".join(out)


def extract(page: str | None, wrapper: "Wrapper | None") -> str:
    stream = tokens(page or "")
    if not stream:
        return ""
    chosen = wrapper.main_slots(stream) if wrapper is not None else None
    if chosen is None:
        chosen = own_slots(stream)
    return blocks(stream, chosen)


def page_form(page: str | None) -> str:
    return json.dumps(fold([t for t, _ in tokens(page or "")]), separators=(",", ":"))


def merge_forms(forms: list[str]) -> str:
    """One wrapper for all forms, in a fixed order: the shortest first."""
    forms = sorted(set(forms), key=lambda f: (len(f), f))
    now = json.loads(forms[0])
    for f in forms[1:]:
        now = align(now, json.loads(f))
    return json.dumps(now, separators=(",", ":"))


# --- Spark ---------------------------------------------------------------------------------------


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON): one row per host of ``pages`` (host, html)."""
    @F.pandas_udf(T.StringType())
    def form_of(html: pd.Series) -> pd.Series:
        return html.map(page_form)

    @F.pandas_udf(T.StringType())
    def merge(forms: pd.Series) -> str:
        return merge_forms(list(forms))

    forms = staged(pages.select("host", form_of("html").alias("form")).groupBy("host", "form").agg(F.count(F.lit(1)).alias("pages")), "forms")
    now, level = forms.select("host", "form"), 0
    while True:
        level += 1
        sizes = now.groupBy("host").count()
        most = sizes.agg(F.max("count")).first()[0] or 0
        bundles = -(-most // FAN_IN)
        bundle = F.pmod(F.xxhash64(F.lit(level), "form"), F.lit(max(1, bundles)))
        now = staged(now.withColumn("bundle", bundle).groupBy("host", "bundle").agg(merge("form").alias("form")).select("host", "form").distinct(),
                     f"wrappers-{level}")
        if bundles <= 1:
            return now.select("host", F.col("form").alias("wrapper"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages`` (page_id, url, html)."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    wrappers = infer_wrappers(rows)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    spread = wrappers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: dict[str, Wrapper] = {}
        for b in batches:
            out = []
            for page, source in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                w = compiled.get(source)
                if w is None and source is not None:
                    if len(compiled) >= 256:
                        compiled.clear()
                    w = compiled[source] = Wrapper(json.loads(source))
                out.append(extract(page, w))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    joined = salted.join(spread, ["host", "salt"], "left").select("page_id", "url", "html", "wrapper")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
