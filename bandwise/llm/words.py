"""Words of many texts at once, as spans of their UTF-8 bytes, and hashes over them (numpy).

A word character is never cut: the rules that use this module separate words at
ASCII bytes only, and those never occur inside a longer UTF-8 sequence.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa

from bandwise.llm.common import ASCII_SPACE, LOWER, UPPER, chained, mix64

#: Words longer than this are hashed one by one.
LONG = 64


def byte_table(separators: bytes) -> np.ndarray:
    """For every byte, whether it belongs to a word."""
    table = np.ones(256, bool)
    table[np.frombuffer(separators, np.uint8)] = False
    return table


#: `[^\x20\x09-\x0D]+`
PLAIN = byte_table(ASCII_SPACE.encode())
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`: digits, a-z and everything beyond ASCII.
ALNUM = byte_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[np.frombuffer(UPPER.encode(), np.uint8)] = np.frombuffer(LOWER.encode(), np.uint8)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after another, offsets: one more than texts); a null text has no bytes."""
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string())
    texts = texts.fill_null("") if texts.null_count else texts
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and offsets[-1] else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWERED[data]


def spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of every word, in order; words end with their text."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = table[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    # A word ends before the first byte outside, or where the next text begins.
    ends = np.flatnonzero(~inside)
    ends = ends[np.searchsorted(ends, starts)] if len(starts) else starts
    text = np.searchsorted(offsets, starts, side="right") - 1
    return starts, np.minimum(ends, offsets[text + 1]), text


def _chunks(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: int) -> np.ndarray:
    """Bytes at..at+7 of every word as a number, zero behind its end; lengths are over ``at``."""
    left = np.minimum(lengths - at, 8)
    out = np.zeros(len(starts), np.uint64)
    for j in range(int(left.max(initial=0))):
        more = left > j
        value = data[np.minimum(starts + (at + j), len(data) - 1)].astype(np.uint64) << np.uint64(8 * j)
        out |= np.where(more, value, np.uint64(0))
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every word."""
    lengths = ends - starts
    first, second = mix64(lengths.astype(np.uint64)), mix64(lengths.astype(np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    for at in range(0, LONG, 8):
        live = np.flatnonzero((lengths > at) & (lengths <= LONG))
        if not len(live):
            break
        part = _chunks(data, starts[live], lengths[live], at)
        first[live] = chained(first[live], part)
        second[live] = chained(second[live] ^ np.uint64(0x5851F42D4C957F2D), part)
    for i in np.flatnonzero(lengths > LONG):
        both = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=16).digest()
        first[i], second[i] = np.frombuffer(both, np.uint64)
    return first, second


def run_hashes(hashes: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the ``width`` words from every place (all of them, or those in ``at``)."""
    n = max(0, len(hashes) - width + 1) if at is None else len(at)
    value = np.full(n, np.uint64(width), np.uint64)
    for i in range(width):
        value = chained(value, hashes[i:i + n] if at is None else hashes[at + i])
    return value


_CRC = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) for b in range(256)], np.uint32) ^ np.uint32(0xFFFFFFFF)


def crc32_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray | None = None) -> np.ndarray:
    """crc32 of every word, or of what ``state`` is the crc32 of with the word behind it."""
    lengths = ends - starts
    crc = np.zeros(len(starts), np.uint32) if state is None else state.astype(np.uint32)
    out, crc = crc.copy(), crc ^ np.uint32(0xFFFFFFFF)
    live = np.flatnonzero(lengths <= LONG)
    at = 0
    while len(live):
        ending = lengths[live] == at
        out[live[ending]] = crc[live[ending]] ^ np.uint32(0xFFFFFFFF)
        live = live[~ending]
        byte = data[starts[live] + at]
        crc[live] = _CRC[(crc[live] ^ byte) & np.uint32(0xFF)] ^ (crc[live] >> np.uint32(8))
        at += 1
    for i in np.flatnonzero(lengths > LONG):
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(out[i]))
    return out


def crc32_space(crc: np.ndarray) -> np.ndarray:
    """crc32 of what ``crc`` is the crc32 of with a space behind it."""
    crc = crc ^ np.uint32(0xFFFFFFFF)
    return _CRC[(crc ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (crc >> np.uint32(8)) ^ np.uint32(0xFFFFFFFF)
