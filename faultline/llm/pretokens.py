"""Splits texts before byte-level merges, as a finite-state machine run over all texts of a batch at once.

The machine reads UTF-8 bytes by class. A chunk of bytes is a map from entry states to exit states; the maps of all
chunks are composed by a parallel prefix scan, and a last pass from the now known entry states marks the cuts.
The language is that of ``public_tokenizers.PATTERN``: contractions, an optional space before runs of letters, of
numbers or of other signs, and white space whose last sign goes to what follows.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import regex

CHUNK = 256
_WARM = 16  # bytes after which nearly all entry states have met in one

# What a byte is to the machine.
_LETTER, _STMD, _RV, _ELL, _E, _NUMBER, _QUOTE, _OTHER, _SPACE, _WHITE, _INNER = range(11)
_FIRST = 11  # added to the class of a text's first byte
# States: inside a run, after white space (one or more; a blank or other last), inside a contraction, after one.
_L, _N, _O, _W1S, _W1X, _W2S, _W2X, _Q, _QE, _QL, _END = range(11)
STATES = 11
_BEFORE, _BEFORE_LAST = 16, 32  # a cut before this byte; before the previous sign


def _start(kind: int) -> int:
    if kind <= _E:
        return _L
    return {_NUMBER: _N, _QUOTE: _Q, _OTHER: _O, _SPACE: _W1S, _WHITE: _W1X}[kind]


def _step(state: int, kind: int) -> int:
    """Next state and cuts."""
    if kind >= _FIRST:
        # A text ends: an unfinished contraction falls apart into its quote and its letter.
        kind -= _FIRST
        pending = _BEFORE_LAST if state in (_QE, _QL) else 0
        return (_L if kind == _INNER else _start(kind)) | _BEFORE | pending
    if kind == _INNER:
        return state
    letter, white = kind <= _E, kind in (_SPACE, _WHITE)
    cut = _start(kind) | _BEFORE
    if state == _Q:
        if kind == _STMD:
            return _END
        if kind == _RV:
            return _QE
        if kind == _ELL:
            return _QL
        return _O if kind in (_QUOTE, _OTHER) else cut
    if state in (_QE, _QL):
        if (state, kind) in ((_QE, _E), (_QL, _ELL)):
            return _END
        return (_L if letter else cut) | _BEFORE_LAST
    if state in (_L, _N, _O):
        same = {_L: letter, _N: kind == _NUMBER, _O: kind in (_QUOTE, _OTHER)}[state]
        return state if same else cut
    if state == _END:
        return cut
    if white:
        return _W2S if kind == _SPACE else _W2X
    joined = _O if kind in (_QUOTE, _OTHER) else _start(kind)
    return {_W1S: joined, _W1X: cut, _W2S: joined | _BEFORE_LAST, _W2X: cut | _BEFORE_LAST}[state]


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class of every code point; next state and cuts by (class, state)."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\s+", _WHITE)):
        for found in regex.finditer(pattern, everything):
            kinds[ord(found[0][0]) : ord(found[0][-1]) + 1] = kind
    for signs, kind in (("stmd", _STMD), ("rv", _RV), ("l", _ELL), ("e", _E), ("'", _QUOTE), (" ", _SPACE)):
        kinds[[ord(x) for x in signs]] = kind
    steps = np.zeros((2 * _FIRST, 16), np.uint8)
    for kind in range(2 * _FIRST):
        for state in range(STATES):
            steps[kind, state] = _step(state, kind)
    return kinds, steps.ravel()


def _classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    kinds, _ = _tables()
    ascii_kinds = np.full(256, _INNER, np.uint8)
    ascii_kinds[:128] = kinds[:128]
    out = ascii_kinds[data]
    leads = np.flatnonzero(data >= 0xC0)
    if len(leads):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        at = [padded[leads + k].astype(np.int64) for k in range(4)]
        rest = [x & 63 for x in at]
        two = (at[0] & 31) << 6 | rest[1]
        three = (at[0] & 15) << 12 | rest[1] << 6 | rest[2]
        four = (at[0] & 7) << 18 | rest[1] << 12 | rest[2] << 6 | rest[3]
        points = np.where(at[0] < 0xE0, two, np.where(at[0] < 0xF0, three, np.minimum(four, 0x10FFFF)))
        out[leads] = kinds[points]
    out[starts] += _FIRST
    return out


def _compose(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan: row i becomes the map of chunks 0 to i."""
    span = 1
    while span < len(maps):
        after = maps.copy()
        after[span:] = np.take_along_axis(maps[span:], maps[:-span], axis=1)
        maps, span = after, span * 2
    return maps


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where a pre-token starts, for texts laid end to end in ``data`` at ``offsets``."""
    if not len(data):
        return np.zeros(0, np.int64)
    _, steps = _tables()
    starts = np.unique(offsets[:-1][np.diff(offsets) > 0])
    classes = _classes(data, starts)
    # One byte more, the first of a text that isn't there, ends the last text.
    lanes = -(-(len(data) + 1) // CHUNK)
    padded = np.full(lanes * CHUNK, _INNER, np.uint8)
    padded[: len(data)] = classes
    padded[len(data)] = _FIRST
    rows = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T).astype(np.int64) << 4

    maps = np.tile(np.arange(STATES, dtype=np.uint8), (lanes, 1))
    for t in range(min(_WARM, CHUNK)):
        maps = steps[rows[t][:, None] | maps] & 15
    apart = np.flatnonzero((maps != maps[:, :1]).any(1))
    state, wide = maps[:, 0].copy(), maps[apart]
    for t in range(_WARM, CHUNK):
        state = steps[rows[t] | state] & 15
        if len(apart):
            wide = steps[rows[t][apart][:, None] | wide] & 15
    maps = np.repeat(state[:, None], STATES, axis=1)
    maps[apart] = wide
    scan = _compose(maps)
    state = np.concatenate([[_END], scan[:-1, _END]]).astype(np.uint8)

    marks = np.empty((CHUNK, lanes), np.uint8)
    for t in range(CHUNK):
        out = steps[rows[t] | state]
        marks[t] = out
        state = out & 15
    marks = np.ascontiguousarray(marks.T).ravel()[: len(data) + 1]
    here = np.flatnonzero(marks & _BEFORE)
    late = np.flatnonzero(marks & _BEFORE_LAST) - 1
    while len(inner := np.flatnonzero((data[late] & 0xC0) == 0x80)):
        late[inner] -= 1
    found = np.unique(np.concatenate([here, late])) if len(late) else here
    return found[found < len(data)]


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The pre-tokens of all texts in order, and for each text the number of pre-tokens before it (one entry more)."""
    starts = cuts(data, offsets)
    whole = data.tobytes()
    ends = np.append(starts[1:], len(data))
    out = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    return out, np.searchsorted(starts, offsets)
