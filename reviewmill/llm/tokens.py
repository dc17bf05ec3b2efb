"""Token ids of whole texts, exactly as the tokenizers library gives them, faster.

The library spends about a microsecond a byte. Both public vocabularies cut a
text into pieces that do not see one another, so a text is cut here at places
where the library cuts too. Pieces are told apart by their bytes a slice of texts at
a time, and each different one is encoded by the library once per worker. A text in which such places are not certain is cut at fewer
places, or not at all.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reviewmill.llm.texts import flat

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Pieces kept per worker process. Bounds memory; others are encoded when met.
CACHED_PIECES = 2_000_000

# Texts are encoded in slices of so many bytes, or one text.
ENCODED_BYTES = 2 << 20

# Spaces that the library may keep together with white space around them.
_JOINED_SPACE = re.compile(r"\s \s|\s \Z|[\x1c-\x1f\x85]")
_ODD_SPACE = re.compile(r"[\x00-\x08\x0e-\x1f\x85\xa0  -‏ -  -⁯　﻿]")

# Kinds of UTF-8 bytes: letters and digits, marks, white space, two bytes of a
# Latin-1 letter, and all others.
_WORD, _MARK, _WHITE, _LEAD, _OTHER = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[0x21:0x7F] = _MARK
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    _KIND[ord(_first) : ord(_last) + 1] = _WORD
_KIND[[0x20, 0x0A]] = _WHITE
_KIND[0xC3] = _LEAD


def simple_texts(column: pa.Array) -> np.ndarray:
    """Which texts are words of ASCII and Latin-1 letters or digits with single
    marks, between single spaces or line ends, none of these at the end."""
    data, bounds = flat(column)
    if not len(data):
        return np.zeros(len(column), bool)
    kind = _KIND[data]
    follows = np.zeros(len(data), bool)
    follows[1:] = kind[:-1] == _LEAD
    # 0xD7 and 0xF7 are signs, not letters; in UTF-8 they end in 0x97 and 0xB7.
    letter = follows & (data >= 0x80) & (data != 0x97) & (data != 0xB7)
    bad = (kind == _OTHER) & ~letter
    bad |= follows & ~letter
    same = np.zeros(len(data), bool)
    same[1:] = (kind[1:] == kind[:-1]) & ((kind[1:] == _MARK) | (kind[1:] == _WHITE))
    same[bounds[:-1][bounds[:-1] < len(data)]] = False
    bad |= same
    full = bounds[1:] > bounds[:-1]
    bad[bounds[1:][full] - 1] |= kind[bounds[1:][full] - 1] == _WHITE
    sums = np.concatenate([[0], np.cumsum(bad)])
    return full & (sums[bounds[1:]] == sums[bounds[:-1]])


# How much of a text may be cut: not at all, before spaces, or also around marks and line ends.
_WHOLE, _SPACES, _MARKS = range(3)


def _piece_starts(data: np.ndarray, bounds: np.ndarray, ways: np.ndarray) -> np.ndarray:
    """Where pieces begin. They cover all bytes; a piece keeps the space it begins with.

    A mark that ends a word is a piece of its own, as is a line end in a text
    that may be cut there; a mark led by a space keeps it.
    """
    way = np.repeat(ways, np.diff(bounds))
    start = np.zeros(len(data), bool)
    start[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    white = (data == 0x20) | (data == 0x0A)
    start |= (data == 0x20) & (way != _WHOLE)
    lines = (data == 0x0A) & (way == _MARKS)
    start |= lines
    start[1:] |= lines[:-1] & (way[1:] == _MARKS)
    closing = ((data == 0x2E) | (data == 0x2C)) & (way == _MARKS)
    closing[-1:] = False
    closing[:-1] &= white[1:]
    closing[1:] &= data[:-1] != 0x20
    ends = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    closing[ends] = False
    return np.flatnonzero(start | closing)


class Encoder:
    """Ids of texts by one vocabulary file; ``space_led`` says how its words begin.

    A vocabulary whose words begin with their space must not lose one beside other white
    space; one that drops white space must not meet a space that it does not know.
    """

    def __init__(self, path: str, space_led: bool):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._odd = _JOINED_SPACE if space_led else _ODD_SPACE
        # Pieces known so far, and their ids one after the other.
        self._known = pa.array([], pa.large_binary())
        self._ids = np.zeros(0, np.uint32)
        self._ends = np.zeros(1, np.int64)

    def _encoded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces by the library, joined, and the number of each."""
        ids, sizes = [], []
        for first in range(0, len(pieces), 4096):
            texts = [p.decode() for p in pieces.slice(first, 4096).to_pylist()]
            found = [x.ids for x in self._library.encode_batch_fast(texts, add_special_tokens=False)]
            sizes += map(len, found)
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32))
        return np.concatenate(ids), np.array(sizes, np.int64)

    def _ways(self, column: pa.Array) -> np.ndarray:
        simple = simple_texts(column)
        ways = np.where(simple, _MARKS, _SPACES).astype(np.int8)
        rest = np.flatnonzero(~simple)
        for i, text in zip(rest, column.take(pa.array(rest)).to_pylist()):
            if text and self._odd.search(text):
                ways[i] = _WHOLE
        return ways

    def _look_up(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of different pieces begin, how many there are, and the ids."""
        found = pc.index_in(pieces, value_set=self._known)
        new = pieces.filter(pc.is_null(found))
        at = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        held, ends = self._ids, self._ends
        if len(new):
            ids, sizes = self._encoded(new)
            at[found.is_null().to_numpy(zero_copy_only=False)] = len(self._known) + np.arange(len(new))
            held = np.concatenate([held, ids])
            ends = np.concatenate([ends, ends[-1] + np.cumsum(sizes)])
            if len(self._known) + len(new) <= CACHED_PIECES:
                self._known = pa.concat_arrays([self._known, new])
                self._ids, self._ends = held, ends
        return ends[at], ends[at + 1] - ends[at], held

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """An id array for each text of an Arrow array; null counts as empty.

        Pieces stay in the Arrow buffer; Arrow tells different ones apart by their
        bytes, and only those are looked up.
        """
        if not len(column):
            return []
        data, bounds = flat(column)
        if not len(data):
            return [np.zeros(0, np.uint32)] * len(column)
        starts = _piece_starts(data, bounds, self._ways(column))
        edges = np.append(starts, len(data)).astype(np.int64)
        cut = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data)]
        ).dictionary_encode()
        firsts, sizes, held = self._look_up(cut.dictionary)
        each = cut.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[each])])
        shift = np.repeat(firsts[each] - ends[:-1], sizes[each])
        ids = held[np.arange(len(shift)) + shift]
        return np.split(ids, ends[np.searchsorted(starts, bounds[1:-1])])


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, space_led: bool) -> Encoder:
    """The encoder of this worker process, kept between tasks."""
    key = (path, space_led)
    if key not in _encoders:
        _encoders[key] = Encoder(path, space_led)
    return _encoders[key]
