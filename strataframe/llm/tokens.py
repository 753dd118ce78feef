"""Ids of texts by way of their distinct units, shared by the tokenizing operators.

A *unit* is a stretch of text that starts at a space, a line feed, or a full stop or comma behind a letter or digit, and
reaches to the next one. Where no white space follows a space or line feed, no pre-token crosses the start of a unit (of
a run of white space the byte-level pattern leaves the last character to what follows, and it ends a run of letters or
digits at punctuation), so a text's ids are its units' ids one after another. Texts for which that does not hold are not
cut, or not at stops and commas. Arrow finds the distinct units of a chunk of texts; only those not met before are
encoded, and numpy puts the ids of all units in order.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units longer than this are not remembered.
LONGEST = 64
#: Between units; a text that has it is not cut.
_MARK = "\x01"

_ADJACENT = re.compile(r"[ \n]\s").search
_STOP_ALONE = re.compile(r"(?<![^\W_])[.,]").search


def latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def spaced_units(text: str) -> str | None:
    """``text`` with a mark between its units, which keep their white space; None if it can't be cut."""
    if _MARK in text or _ADJACENT(text):
        return None
    if not _STOP_ALONE(text):
        text = text.replace(",", "\x01,").replace(".", "\x01.")
    return text.replace("\n", "\x01\n").replace(" ", "\x01 ")


def bare_units(text: str) -> str | None:
    """The same for tokenizers that drop white space: units are what is between spaces and line feeds.

    Stops and commas part units in Latin-1 texts only: elsewhere lower-casing can make marks that join them.
    """
    if _MARK in text:
        return None
    if latin(text) and not _STOP_ALONE(text):
        text = text.replace(",", "\x01,").replace(".", "\x01.")
    return text.replace("\n", _MARK).replace(" ", _MARK)


class UnitEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, each distinct unit once as long as it is remembered.

    cut: a function above. new: ids of units, each as bytes. About ``bound`` units are remembered, the newest.
    """

    def __init__(self, cut: Callable[[str], str | None], new: Callable[[list[str]], list[bytes]], bound: int = 1_000_000):
        self.cut, self.new, self.bound = cut, new, bound
        self.memo: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.memo) >= self.bound:
            for unit in list(islice(self.memo, self.bound // 2)):  # the oldest go
                del self.memo[unit]
        marked = [self.cut(t) for t in texts]
        lists = pc.split_pattern(pa.array([m or "" for m in marked], pa.large_string()), _MARK)
        offsets = lists.offsets.to_numpy()
        coded = lists.values.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        ids = list(map(self.memo.get, distinct))
        missing = [k for k, x in enumerate(ids) if x is None]
        for k, x in zip(missing, self.new([distinct[k] for k in missing]), strict=True):
            ids[k] = x
            if len(distinct[k]) <= LONGEST:
                self.memo[distinct[k]] = x
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(lengths) - lengths
        at = coded.indices.to_numpy()
        each = lengths[at]
        ends = np.concatenate([[0], np.cumsum(each)])
        flat = np.frombuffer(b"".join(ids), "<u4")[np.repeat(starts[at] - ends[:-1], each) + np.arange(ends[-1])].tobytes()
        bounds = (4 * ends[offsets]).tolist()
        out = [flat[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        for i, m in enumerate(marked):
            if m is None:
                out[i] = self.new([texts[i]])[0]
        return out


#: Encoders of this worker process, which goes on to other tasks.
_KEPT: dict[tuple, UnitEncoder] = {}


def kept(key: tuple, make: Callable[[], UnitEncoder]) -> UnitEncoder:
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def library_encoder(path: str, spaces: str, bound: int = 1_000_000) -> UnitEncoder:
    """Whole texts by a tokenizer file of the ``tokenizers`` library.

    Strings of special tokens in a text are ordinary text and none is added. ``spaces`` says what the tokenizer does
    with white space: "kept" (byte-level) or "dropped".
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True

    def new(texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in (x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False))]

    return UnitEncoder(spaced_units if spaces == "kept" else bare_units, new, bound)


def chunks(batches: Iterable, columns: list[str], text: int, chars: int = 3_000_000) -> Iterator[list[tuple]]:
    """Rows of Arrow batches as tuples of ``columns``, in lists whose texts have about ``chars`` characters in all."""
    rows: list[tuple] = []
    held = 0
    for batch in batches:
        picked = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        for i in range(batch.num_rows):
            row = tuple(c[i].as_py() for c in picked)
            rows.append(row)
            held += len(row[text] or "") + 64
            if held >= chars:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows
