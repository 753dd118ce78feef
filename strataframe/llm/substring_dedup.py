"""Removal of repeated passages by hashing windows of words and whole lines.

A text is its lower-cased words, whatever white space and line feeds stand between them. Windows of ``min_words`` words
are hashed where the text itself says so: at each word whose pair with the next has the least hash among some ``SPAN``
neighbouring words, and at both ends of the text. As that depends on words of the passage only, every passage of
``min_words + SPAN - 1`` words or more that stands in two texts has a window that both hash, wherever it begins, in any
case and over line feeds; all of it but at most ``SPAN - 1`` words at each end is covered. Each line of ``min_line`` words
or more is hashed as a whole too. The digests of all documents are grouped; the occurrence in the document with the smallest identifier (and
there the first; occurrences that overlap it don't count) stays, all others are removed: lines with their line feed, and
the words of windows. What is removed is kept as offsets (code points) into the original text.

Scale: each document sends a digest once, to where all rows of the digest meet; only repeats go on, back to their
documents. A digest that a task meets very often is dealt to several places from then on, so no task gets all its rows.

Cases: null and empty texts have no words and stay as they are. A null identifier ranks first. Rows with one identifier
don't count as repeats of each other, so repeated rows are all treated like the first of them. Texts of any length are
cut whole. Extra columns pass through; output columns that clash get a number. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fresh, tidy
from .shingles import mix

MIN_WORDS = 25
#: Among so many neighbouring words at least one begins a window.
SPAN = 10
#: Fewest words of a line that is hashed as a whole: shorter ones (headings, greetings, items) repeat without being copied.
MIN_LINE = 10
#: A digest that a task has met so often is dealt to so many places.
LOCAL, SALTS = 16, 64
_FREQUENT_BITS = 21
_WORD = re.compile(r"\S+")
_NULL_ID = -(1 << 63)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD95)
_PAIR = np.uint64(0xBF58476D1CE4E5B9)


class Words(dict):
    """Word -> 16 bytes of hash of its lower case; remembered up to a bound."""

    def __missing__(self, word: str) -> bytes:
        if len(self) > 200_000:
            self.clear()
        value = xxhash.xxh3_128_digest(word.lower().encode("utf-8", "surrogatepass"))
        if len(word) <= 64:
            self[word] = value
        return value


class Powers:
    """Powers of the two bases and of their inverses modulo 2**64, as many as the longest text so far has words."""

    def __init__(self) -> None:
        self.up = self.down = np.ones((1, 2), np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            step = np.array([[pow(b, k, 1 << 64) for b in _BASES], [pow(b, -k, 1 << 64) for b in _BASES]], np.uint64)
            self.up, self.down = np.vstack([self.up, self.up * step[0]]), np.vstack([self.down, self.down * step[1]])
        return self.up, self.down


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Words at which a window of ``width`` words is hashed. first: a hash of each word."""
    n = len(first)
    if n < width:
        return np.empty(0, np.int64)
    rank = first * _PAIR
    rank[:-1] += first[1:]
    rank = mix(rank)
    span = min(SPAN, n)

    def slide(x: np.ndarray, least: np.ufunc) -> np.ndarray:
        """least of each ``span`` neighbours."""
        have = 1
        while have < span:
            more = min(have, span - have)
            x = least(x[: len(x) - more], x[more:])
            have += more
        return x

    low = slide(rank, np.minimum)
    # a word is the least of some span if the greatest of the least values of the spans around it is its own
    low = np.concatenate([np.zeros(span - 1, np.uint64), low, np.zeros(span - 1, np.uint64)])
    begins = slide(low, np.maximum) == rank
    begins[0] = begins[n - width] = True
    return np.flatnonzero(begins[: n - width + 1])


def digests(text: str | None, min_words: int, min_line: int, words: Words, powers: Powers) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word after the last) of each line, first words of the windows, and the two parts of the digests of the lines of ``min_line`` words or more and then of the windows."""
    found, bounds = [], []
    for line in (text or "").split("\n"):
        bounds.append((len(found), len(found)))
        if part := line.split():
            found += part
            bounds[-1] = (bounds[-1][0], len(found))
    n = len(found)
    if not n:
        return bounds, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    hashes = np.frombuffer(b"".join(map(words.__getitem__, found)), "<u8").reshape(n, 2)
    up, down = powers.upto(n)
    sums = np.zeros((n + 1, 2), np.uint64)
    np.cumsum(hashes * up[:n], axis=0, out=sums[1:])
    begins = window_starts(hashes[:, 0], min_words)
    lines = np.array([x for x in bounds if x[1] - x[0] >= min_line], np.int64).reshape(-1, 2)
    a, b = np.concatenate([lines[:, 0], begins]), np.concatenate([lines[:, 1], begins + min_words])
    value = mix((sums[b] - sums[a]) * down[a])
    return bounds, begins, value[:, 0].astype(np.int64), value[:, 1].astype(np.uint32).view(np.int32)


def remove(text: str, foreign: set[tuple[int, int]], min_words: int, min_line: int, words: Words, powers: Powers) -> tuple[str, list[tuple[int, int]]]:
    """The text that stays and the removed spans. foreign: digests that a document of smaller identifier has."""
    bounds, begins, high, low = digests(text, min_words, min_line, words, powers)
    keys = list(zip(high.tolist(), low.tolist(), strict=True))
    filled = [x for x in bounds if x[1] - x[0] >= min_line]
    gone = np.zeros(bounds[-1][1], bool)
    seen: set[tuple[int, int]] = set()
    for (a, b), key in zip(filled, keys, strict=False):
        if key in foreign or key in seen:
            gone[a:b] = True
        seen.add(key)
    stays: dict[tuple[int, int], int] = {}
    for a, key in zip(begins.tolist(), keys[len(filled) :], strict=True):
        if key in foreign or stays.setdefault(key, a) + min_words <= a:
            gone[a : a + min_words] = True
    if not gone.any():
        return text, []
    spans, at = [], 0
    for line, (a, b) in zip(text.split("\n"), bounds, strict=True):
        here = gone[a:b]
        if a < b and here.all():
            spans.append((at, min(at + len(line) + 1, len(text))))
        elif here.any():
            begin = [m.start() for m in _WORD.finditer(line)] + [len(line)]
            edges = np.flatnonzero(np.diff(here, prepend=False, append=False)).tolist()
            spans += [(at + begin[i], at + begin[j]) for i, j in zip(edges[::2], edges[1::2], strict=True)]
        at += len(line) + 1
    kept, done = [], 0
    for a, b in spans:
        kept.append(text[done:a])
        done = b
    return "".join(kept) + text[done:], spans


class Frequent:
    """Keys that this task has met ``LOCAL`` times before: counters of fixed size choose those worth an exact count."""

    def __init__(self) -> None:
        self.table = np.zeros(1 << _FREQUENT_BITS, np.uint32)
        self.exact: dict[int, int] = {}

    def flags(self, keys: np.ndarray, local: int) -> np.ndarray:
        at = (mix(keys.view(np.uint64)) >> np.uint64(64 - _FREQUENT_BITS)).astype(np.int64)
        worth = np.flatnonzero(self.table[at] >= local)
        np.add.at(self.table, at, np.uint32(1))
        out = np.zeros(len(keys), bool)
        chosen = keys[worth].tolist()
        out[worth] = [self.exact.get(k, 0) >= local for k in chosen]
        for k in chosen:
            self.exact[k] = self.exact.get(k, 0) + 1
        return out


def _digest_rows(df: DataFrame, id_col: str, text_col: str, min_words: int, min_line: int, local: int) -> DataFrame:
    """Rows (h1, h2, id, place): each digest of each document once.

    place: 0; 1 to ``SALTS`` by identifier for digests that the task has met ``local`` times at place 0; -1 in a row of its own
    for a document that repeats something of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        words, powers, frequent = Words(), Powers(), Frequent()
        for whole in batches:
            for k in range(0, whole.num_rows, 100):
                highs, lows, ids, own = [], [], [], []
                for key, text in zip(whole.column(0).slice(k, 100).to_pylist(), whole.column(1).slice(k, 100), strict=True):
                    _, _, high, low = digests(text.as_py(), min_words, min_line, words, powers)
                    unique, at = np.unique(high, return_index=True)  # two digests of one text that share 64 bits are taken for one
                    if len(unique) < len(high):
                        own.append(key)
                    highs.append(unique)
                    lows.append(low[at])
                    ids.append(np.full(len(at), key, np.int64))
                high, low, of = (np.concatenate(x) for x in (highs, lows, ids))
                many = frequent.flags(high, local)
                place = np.where(many, 1 + (mix(of.view(np.uint64)) % np.uint64(SALTS)).astype(np.int32), 0).astype(np.int32)
                marks = np.array(own, np.int64)
                arrays = [np.concatenate([high, marks]), np.concatenate([low, np.zeros(len(marks), np.int32)]), np.concatenate([of, marks]), np.concatenate([place, np.full(len(marks), -1, np.int32)])]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["h1", "h2", "id", "place"])

    picked = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "h1 long, h2 int, id long, place int")


def _repeats(rows: DataFrame, local: int) -> DataFrame:
    """Rows (h1, h2, id) of digests that a document of smaller identifier has, and a row for each mark.

    The rows of a digest meet by place, and what isn't the smallest of its place is a repeat. A digest that a task has met
    very often has rows at several places, and then at least ``local`` at place 0; the smallest of these places meet again.
    """
    at = Window.partitionBy("h1", "h2", "place")
    met = rows.withColumns({"first": F.min("id").over(at), "n": F.count("*").over(at)})
    again = (F.col("id") > F.col("first")) | (F.col("place") < 0)
    held = cut(met.select("h1", "h2", "id", again.alias("again"), (~again & ((F.col("place") > 0) | (F.col("n") >= local))).alias("open")).where("again or open"))
    mins = held.where("open").withColumn("first", F.min("id").over(Window.partitionBy("h1", "h2"))).where("id > first")
    return held.where("again").select("h1", "h2", "id").unionByName(mins.select("h1", "h2", "id"))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_line: int = MIN_LINE, local: int = LOCAL) -> DataFrame:
    """``df`` with repeats removed from ``text_col``, and ``removed_spans`` (begin and stop in the original) added."""
    min_words, min_line = max(1, min_words), max(1, min_line)
    again = _repeats(_digest_rows(df, id_col, text_col, min_words, min_line, local), local)
    key, got = fresh(df, "dedup_key"), fresh(df, "foreign_digests")
    foreign = again.groupBy(F.col("id").alias(key)).agg(F.collect_list(F.struct("h1", "h2")).alias(got))  # as many as a document has windows and lines
    joined = df.withColumn(key, F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID))).join(foreign, key, "left").drop(key)
    spans = fresh(df, "removed_spans")
    kept = df.columns
    kind = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("stop", T.LongType())]))
    schema = T.StructType([*df.schema.fields, T.StructField(spans, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        words, powers = Words(), Powers()
        target = pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                texts, removed = [], []
                for text, found in zip(batch.column(batch.schema.get_field_index(text_col)).to_pylist(), batch.column(batch.schema.get_field_index(got)), strict=True):
                    out = []
                    if text and found.is_valid:  # others repeat nothing
                        text, out = remove(text, {(x["h1"], x["h2"]) for x in found.as_py()}, min_words, min_line, words, powers)
                    texts.append(text)
                    removed.append([{"begin": a, "stop": b} for a, b in out])
                arrays = [pa.array(texts, batch.schema.field(c).type) if c == text_col else batch.column(batch.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(removed, target)], names=[*kept, spans])

    return joined.mapInArrow(run, schema)
