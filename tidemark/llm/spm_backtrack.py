"""SentencePiece merge-type (BPE) encoding by backtracking (operator 4).

The library merges the best-scored adjacent pair again and again.  The same
result is found from left to right:

* an Aho-Corasick automaton over all pieces gives, in one pass, the pieces
  that start at each position;
* two adjacent tokens are compatible if merging their joined characters anew
  yields just these two.  A token sequence is the library's result exactly
  when all its neighbours are compatible (a first merge across a border would
  happen in the pair alone too), so it is the only such sequence;
* the search takes the longest compatible piece, tries shorter ones where it
  gets stuck, and steps back when none is left.  A position where it was
  stuck can never be a border of the result whatever token leads there; a
  bitfield keeps these positions, so no position fails twice.

Pieces never reach across certain character borders (checked against the
vocabulary), so a text is cut there, and equal stretches are encoded once per
worker and kept in two generations of bounded size.

Only models with the identity normaliser, normal, control, unknown and byte
pieces are read; others raise ``ValueError``.

Defined results: a null or empty text is the end id alone and decodes to "";
repeated rows are encoded each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, worker_caches

SPACE = "▁"
CACHE_STRETCHES = 300_000  # per generation
CACHE_PAIRS = 500_000

# Fixed values of the model file: piece types and message field numbers
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
FIELD_PIECE, FIELD_TRAINER, FIELD_NORMALIZER = 1, 2, 3
BPE_TYPE = 2

#: marks before which a text may be cut after a letter, if the vocabulary agrees
MARKS = ".,;:!?%&$#*|"


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol-buffer message."""
    def varint(i):
        value = shift = 0
        while True:
            byte = raw[i]
            value |= (byte & 127) << shift
            i, shift = i + 1, shift + 7
            if byte < 128:
                return value, i

    at = 0
    while at < len(raw):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = raw[at: at + size], at + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, at = raw[at: at + size], at + size
        yield key >> 3, value


class BacktrackingEncoder:
    def __init__(self, path: str):
        import ahocorasick

        with open(path, "rb") as f:
            raw = f.read()
        self.pieces: list[tuple[str, int]] = []
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.unknown, self.end_id = 0, None
        norm: dict = {}
        for number, value in _fields(raw):
            if number == FIELD_PIECE:
                self._add(dict(_fields(value)))
            elif number == FIELD_NORMALIZER:
                norm = dict(_fields(value))
            elif number == FIELD_TRAINER and dict(_fields(value)).get(3) != BPE_TYPE:
                raise ValueError("not a merge-type (BPE) model")
        if norm.get(2) or norm.get(4, 1) or not norm.get(5, 1):
            raise ValueError("only the identity normaliser with escaped spaces is read")
        self.dummy_prefix = bool(norm.get(3, 1))
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            if len(p) > 1:
                self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.young: dict[str, str] = {}  # stretch -> its ids, joined by one space
        self.old: dict[str, str] = {}
        self.faithful = True
        self.stretch = self._stretches()

    def _add(self, f: dict) -> None:
        text, kind = f[1].decode("utf-8"), f.get(3, NORMAL)
        i = len(self.pieces)
        self.pieces.append((text, kind))
        if kind == NORMAL:
            self.ids[text] = i
            self.score[text] = struct.unpack("<f", f[2])[0] if 2 in f else 0.0
        elif kind == BYTE:
            self.byte_ids[int(text[3:5], 16)] = i
        elif kind == UNKNOWN:
            self.unknown = i
        elif kind == CONTROL:
            if text == "</s>":
                self.end_id = i
        else:
            raise ValueError(f"piece type {kind} is not read")

    def _stretches(self):
        """Cuts a text into stretches that no piece crosses, as far as the vocabulary allows."""
        inside = {(a, b) for p in self.ids for a, b in zip(p, p[1:])}
        if any(b == SPACE != a for a, b in inside) or any("\n" in x for x in inside):
            return re.compile(r"(?s).+").findall
        letter = re.compile(r"[^\W\d_]")
        glued = {b for a, b in inside if letter.match(a)}
        marks = re.escape("".join(c for c in MARKS if c not in glued))
        word = rf"{SPACE}*+[^{SPACE}\n{marks}]++(?<=[^\W\d_])(?=[{marks}])|" if marks else ""
        return re.compile(rf"{word}{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall

    def merge(self, text: str) -> list[str]:
        """The library's merging, done directly: best score first, leftmost among equals."""
        parts = list(text)
        none = float("-inf")
        scores = [self.score.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == none:
                break
            at = scores.index(best)
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = self.score.get(parts[at - 1] + parts[at], none)
            if at < len(scores):
                scores[at] = self.score.get(parts[at] + parts[at + 1], none)
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Adjacent tokens stay as they are when merged anew (a = "": b stays whole)."""
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merge(a + b) == ([a, b] if a else [b])
        return known

    def tokens(self, text: str) -> list[str]:
        """The merge result of a non-empty stretch, by backtracking."""
        n = len(text)
        starts = [[1] for _ in range(n)]
        for last, size in self.automaton.iter(text):
            starts[last - size + 1].append(size)  # ends ascend, so the sizes of a start do
        failed, stuck = bytearray((n >> 3) + 1), False
        borders, left = [0], [len(starts[0])]  # borders[i]: where token i starts; left[i]: how many sizes are left to try there
        out: list[str] = []
        at, before, known = 0, "", self.pairs.get
        while at < n:
            sizes, k = starts[at], left[-1]
            while k:
                k -= 1
                end = at + sizes[k]
                if stuck and failed[end >> 3] >> (end & 7) & 1:
                    continue
                token = text[at:end]
                fits = known((before, token))
                if self.compatible(before, token) if fits is None else fits:
                    left[-1] = k
                    out.append(token)
                    borders.append(end)
                    if end < n:
                        left.append(len(starts[end]))
                    at, before = end, token
                    break
            else:
                stuck = True
                failed[at >> 3] |= 1 << (at & 7)
                borders.pop()
                left.pop()
                out.pop()
                at, before = borders[-1], out[-1] if out else ""
        return out

    def token_ids(self, token: str) -> list[int]:
        i = self.ids.get(token)
        if i is not None:
            return [i]
        if self.byte_ids:
            return [self.byte_ids[b] for b in token.encode("utf-8")]
        return [self.unknown]

    def decode_pieces(self, ids: list[int]) -> str:
        """Text of ids; space marks become spaces, runs of byte pieces become characters, control ids nothing."""
        out, pending = [], bytearray()
        for i in ids:
            text, kind = self.pieces[i]
            if kind == BYTE:
                pending.append(int(text[3:5], 16))
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            if kind == NORMAL:
                out.append(text.replace(SPACE, " ") if SPACE in text else text)
            elif kind == UNKNOWN:
                out.append(f" {SPACE}⁇ "[0] + "⁇ ")
        if pending:
            out.append(pending.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.decode_pieces(ids)
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        return (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)

    def _learn(self, new: set[str]) -> None:
        """Put ``new`` stretches, which the young generation lacks, into it."""
        if len(self.young) > CACHE_STRETCHES:
            self.old, self.young = self.young, {}
        for s in new:
            kept = self.old.get(s)
            if kept is None:
                ids = [i for t in self.tokens(s) for i in self.token_ids(t)]
                kept = " ".join(map(str, ids))
                self.faithful = self.faithful and self.decode_pieces(ids) == s.replace(SPACE, " ")
            self.young[s] = kept

    def encode_text(self, text: str) -> tuple[str, str]:
        """(ids with the end id, joined by one space; decoded text).

        Stretches decode one by one; while every stretch met so far has
        decoded to itself with spaces for space marks (always, with byte
        pieces), the decoded text is the normalised one."""
        text = self.normalise(text)
        parts = self.stretch(text)
        known = list(map(self.young.get, parts))
        if None in known:
            missing = [i for i, ids in enumerate(known) if ids is None]
            self._learn({parts[i] for i in missing})
            for i in missing:
                known[i] = self.young[parts[i]]
        known.append(str(self.end_id))
        ids = " ".join(known)
        if not self.faithful:
            return ids, self.decode(list(map(int, ids.split(" "))))
        decoded = text.replace(SPACE, " ")
        return ids, decoded[1:] if self.dummy_prefix and decoded.startswith(" ") else decoded

    def encode(self, text: str) -> list[int]:
        """All ids of a text, without the end id."""
        return [i for s in self.stretch(self.normalise(text)) for t in self.tokens(s) for i in self.token_ids(t)]


def encoder(path: str) -> BacktrackingEncoder:
    kept = worker_caches("pieces")
    if path not in kept:
        kept[path] = BacktrackingEncoder(path)
    return kept[path]


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by one space, end id included) and decoded text of every row.

    One narrow pass, no shuffle."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_path)
        for b in batches:
            rows = [enc.encode_text(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r[0].count(" ") + 1 for r in rows], pa.int64()), pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_tokens long, ids string, decoded string")
