"""Words of texts as arrays of 64-bit word hashes, and hashes of runs of words."""

from __future__ import annotations

import numpy as np

from lapgraph.llm.common import mix64

#: An odd base and its inverse modulo 2**64 for running sums of word hashes.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
#: Bytes hashed at once, but for a longer word.
PIECE = 1 << 22

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_BYTE_AT = mix64(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of each word of a text in UTF-8, words being cut at ASCII white space.

    A hash depends on the bytes of the word alone, so it is the same in every process.
    """
    if len(data) <= PIECE:
        return _hashes(data)
    out, begin = [], 0
    while begin < len(data):
        end = begin + PIECE
        while end < len(data) and not _IS_SPACE[data[end]]:
            end += 1
        out.append(_hashes(data[begin:end]))
        begin = end
    return np.concatenate(out)


def _hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    edge = np.ones(len(raw) + 2, bool)
    np.take(_IS_SPACE, raw, out=edge[1:-1])
    turns = np.flatnonzero(edge[1:] != edge[:-1])
    starts, lengths = turns[::2], turns[1::2] - turns[::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    ends = np.cumsum(lengths)
    place = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
    own = raw[~edge[1:-1]]
    values = np.take(_BYTE_AT, (place & 255) << 8 | own)
    if lengths.max() > 256:
        values *= mix64((place >> 8).astype(np.uint64)) | np.uint64(1)
    sums = np.zeros(len(own) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return mix64(sums[ends] - sums[ends - lengths] + lengths.astype(np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_POWERS = {"up": _powers(BASE, 1 << 12), "down": _powers(INVERSE, 1 << 12)}


def _sums(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of words times powers of BASE, and the powers of its inverse."""
    n = len(words)
    if len(_POWERS["up"]) <= n:
        size = 1 << int(n).bit_length()
        _POWERS["up"], _POWERS["down"] = _powers(BASE, size), _powers(INVERSE, size)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * _POWERS["up"][:n], out=sums[1:])
    return sums, _POWERS["down"]


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` words; entry i belongs to the run that starts at i."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    sums, down = _sums(words)
    n = len(words) - length + 1
    return mix64((sums[length:] - sums[:-length]) * down[:n] + np.uint64(length))


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run [start, end) of words, of any lengths."""
    sums, down = _sums(words)
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
