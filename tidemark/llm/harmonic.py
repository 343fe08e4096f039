"""Harmonic packing of token sequences (operator 7).

Piece lengths fall into reciprocal-capacity classes: class ``j`` holds the
lengths in ``(C/(j+1), C/j]``, and a bin of class ``j`` takes exactly ``j``
pieces.  Documents may be cut, so each is cut into whole bins (class 1) and
at most one piece of each exact fraction C/2, C/4, C/8; only the rest, below
C/8, falls into an inexact class.  Classes from ``LAST_CLASS`` on (very short
pieces) share bins filled one after another.

Every worker fills its own bins while it reads its rows: no shuffle of
documents or ids.  Pieces left in a worker's unfilled bins (at most j-1 per
class) go to a second round, where one worker takes the leftovers of
``FAN_IN`` workers, and so on until one worker is left; its last pieces are
packed first-fit, longest first.  Each round's input is bounded by the number
of workers of the round before, never by the number of documents.

Defined results: a null or empty text is the end id alone; a null doc_id is
kept; repeated rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, staged, worker_caches

CAPACITY = 1024
EXACT = (2, 4, 8)
LAST_CLASS = 32
FAN_IN = 64
CACHE_WORDS = 400_000  # per generation: about 100 MB for both

# Fixed values of the byte-level vocabulary: end id, special token, pre-token pattern
END_ID = 0
SPECIAL = "<|endoftext|>"
PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PROBES = ("a\nb", " The quick, brown fox's 3.50 jumps!", "\nÄpfel über  日本語", " qzxv'll")

#: white space other than the two characters that texts are cut at
_OTHER_SPACE = [chr(i) for i in range(0x3001) if chr(i).isspace() and chr(i) not in " \n"]
_ASCII_SPACE = [c for c in _OTHER_SPACE if c.isascii()]


def odd_space(text: str) -> bool:
    """Whether a cut before every space or line feed might split a run of white
    space (substring searches: several times faster than a pattern)."""
    return (text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text
            or any(c in text for c in (_ASCII_SPACE if text.isascii() else _OTHER_SPACE)))


def cut_words(text: str) -> list[str]:
    """``text`` (without odd space) cut before each space and line feed, and before
    commas and full stops if every one of them follows a letter or a digit (else
    one may belong to a longer mark).  All words but the first lack their first
    character if it is a space; a carriage return marks a comma or full stop."""
    parts = text.replace("\n", " \n")
    marked = parts.replace(",", " \r,").replace(".", " \r.")
    *before, _ = marked.split(" \r")
    ends = "".join([s[-1:] for s in before])
    return (marked if len(ends) == len(before) and (not ends or ends.isalnum()) else parts).split(" ")


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes for themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long, worker long")


class WordEncoder:
    """ids of whole texts as the ``tokenizers`` library gives them, word by word.

    Byte-level pre-tokens never run from a visible character into white
    space, nor from a letter or digit into a mark, so a text is cut before
    each space and line feed, and before commas and full stops that follow a
    letter or digit.  Equal words are encoded once and kept in two generations: when
    the young one is full it becomes the old one, from which words in use
    come back.  New words go through ``tiktoken``'s merges over the same
    file's vocabulary (ids are merge ranks there), several times faster for
    single words; if the two libraries differ on a probe, and for texts that
    hold the special token, ``tokenizers`` does the work."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.cache_words = cache_words
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        symbols = byte_symbols()
        try:
            ranks = {bytes(symbols[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
            fast = tiktoken.Encoding("words", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
            agrees = all(fast.encode_ordinary(t) == self._library(t) for t in PROBES)
        except (KeyError, ValueError):  # not a byte-level vocabulary
            agrees = False
        self.by_word = agrees
        self._ids = fast.encode_ordinary if agrees else self._library

    def _library(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _raw(self, text: str) -> bytes:
        return array("I", self._ids(text)).tobytes()

    def _learn(self, words: list[str]) -> None:
        for w in words:
            self.young[w] = self._raw(w[1:] if w[:1] == "\r" else w if w[:1] == "\n" else " " + w)

    def _fill(self, words: list[str]) -> None:
        """Put all of ``words`` into the young generation."""
        if len(self.young) > self.cache_words:
            self.old, self.young = self.young, {}
        new = []
        for w in set(words).difference(self.young):
            kept = self.old.get(w)
            if kept is None:
                new.append(w)
            else:
                self.young[w] = kept
        if new:
            self._learn(new)

    def encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for text in texts:
            if not text:
                yield b""
            elif SPECIAL in text:
                yield array("I", self._library(text)).tobytes()
            elif not self.by_word or odd_space(text):
                yield self._raw(text)
            else:
                first, *words = cut_words(text)
                try:
                    rest = list(map(self.young.__getitem__, words))
                except KeyError:
                    self._fill(words)
                    rest = list(map(self.young.__getitem__, words))
                yield self._raw(first) + b"".join(rest)


def encoder(path: str) -> WordEncoder:
    kept = worker_caches("packing")
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def cut_lengths(n: int, capacity: int = CAPACITY, exact: tuple[int, ...] = EXACT) -> list[int]:
    """Lengths of the pieces of ``n`` ids, in text order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    for j in exact:
        part = capacity // j
        if part and rest >= part:
            out.append(part)
            rest -= part
    if rest:
        out.append(rest)
    return out


class Bins:
    """Open bins of one worker: at most one per class."""

    def __init__(self, first_id: int, capacity: int = CAPACITY, last_class: int = LAST_CLASS):
        self.capacity, self.last_class = capacity, last_class
        self.next_id = first_id
        self.open: dict[int, list[tuple]] = {}
        self.filled: dict[int, int] = {}

    def _close(self, cls: int) -> list[tuple]:
        pieces, at, out = self.open.pop(cls), 0, []
        for p in pieces:
            out.append((*p[:5], self.next_id, at))
            at += p[2]
        self.next_id += 1
        self.filled.pop(cls, None)
        return out

    def add(self, piece: tuple) -> list[tuple]:
        """piece: (doc_id, start, length, crc, doc_tokens); returns the pieces of a bin that it fills."""
        length = piece[2]
        cls = min(self.capacity // length, self.last_class)
        out: list[tuple] = []
        if cls == self.last_class and self.filled.get(cls, 0) + length > self.capacity:
            out = self._close(cls)
        self.open.setdefault(cls, []).append(piece)
        self.filled[cls] = self.filled.get(cls, 0) + length
        if (len(self.open[cls]) == cls and cls < self.last_class) or self.filled[cls] == self.capacity:
            out = out + self._close(cls)
        return out

    def leftovers(self) -> list[tuple]:
        return [(*p[:5], None, None) for cls in sorted(self.open) for p in self.open[cls]]

    def finish(self) -> list[tuple]:
        """Pack what is left over first-fit, longest piece first."""
        left = sorted((p for ps in self.open.values() for p in ps), key=lambda p: (-p[2], _order(p[0]), p[1]))
        bins: list[list] = []
        for p in left:
            for b in bins:
                if b[0] + p[2] <= self.capacity:
                    break
            else:
                b = [0, []]
                bins.append(b)
            b[1].append((p, b[0]))
            b[0] += p[2]
        out = []
        for b in bins:
            out += [(*p[:5], self.next_id, at) for p, at in b[1]]
            self.next_id += 1
        self.open, self.filled = {}, {}
        return out


def _order(v) -> tuple:
    return (v is not None, v if v is not None else 0)


def _batch(rows: list[tuple], worker: int) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    cols = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in cols), pa.array([worker] * len(rows), pa.int64())], names=[*names, "worker"])


def _first_id(level: int, worker: int) -> int:
    """Sequence ids of different rounds and workers never meet."""
    return (level << 56) | (worker << 32)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  ``docs`` has doc_id and text; a document's ids are
    the tokenizer's plus the end id 0."""
    small_batches(docs.sparkSession)

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        worker = TaskContext.get().partitionId()
        enc, bins = encoder(tokenizer_path), Bins(_first_id(0, worker), capacity)
        end = END_ID.to_bytes(4, "little")
        for b in batches:
            out: list[tuple] = []
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for doc_id, raw in zip(ids, enc.encode_batch(texts)):
                raw += end
                n, start = len(raw) // 4, 0
                for length in cut_lengths(n, capacity):
                    crc = zlib.crc32(raw[4 * start: 4 * (start + length)])
                    out += bins.add((doc_id, start, length, crc, n))
                    start += length
            yield _batch(out, worker)
        yield _batch(bins.leftovers(), worker)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    now = staged(source.mapInArrow(first_round, PIECE_SCHEMA), "pack")
    done = now.where("sequence_id is not null")
    level, workers = 0, (now.agg(F.max("worker")).first()[0] or 0) + 1
    while True:
        level += 1
        last = workers <= FAN_IN
        left = now.where("sequence_id is null").withColumn("worker", F.floor(F.col("worker") / FAN_IN).cast("long"))
        workers = -(-workers // FAN_IN)
        now = staged(_next_round(left, level, last, capacity), f"pack-{level}")
        done = done.unionAll(now.where("sequence_id is not null"))
        if last:
            return done.drop("worker")


def _next_round(left: DataFrame, level: int, last: bool, capacity: int) -> DataFrame:
    """Fill bins from the leftovers of FAN_IN workers each; the last round leaves nothing over."""

    def fill(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = key[0].as_py()
        bins = Bins(_first_id(level, worker), capacity)
        for b in batches:
            out: list[tuple] = []
            for p in zip(*(b.column(i).to_pylist() for i in range(5))):
                out += bins.add(p)
            yield _batch(out, worker)
        yield _batch(bins.finish() if last else bins.leftovers(), worker)

    ordered = left.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "worker")
    return ordered.groupBy("worker").applyInArrow(fill, PIECE_SCHEMA)
