"""Word hashes and shingle sets of UTF-8 texts, vectorised over Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes hashed at once: bounds the arrays of a task.
CHUNK = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed odd numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(salt)) | np.uint64(1)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK + 4096)
            inverse = pow(_BASE, -1, 1 << 64)
            with np.errstate(over="ignore"):
                cls.up = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _BASE, np.uint64), dtype=np.uint64)])
                cls.down = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, inverse, np.uint64), dtype=np.uint64)])
        return cls.up, cls.down


_BYTES = seeds(256, 77)

#: Byte values between words: white space.
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text (A-Z lower-cased), and the index of its first word per text (n + 1 numbers)."""
    hashes, at, *_ = words_in_place(texts)
    return hashes, at


def words_in_place(texts: pa.Array, gap: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As `word_hashes`, with the first byte of each word and the byte after its last, the bytes, and where each text starts in them.

    A word is a run of bytes that `gap` (a flag per byte value) does not name, by default those other than space and \\x09-\\x0D; nulls
    have none. The texts are hashed in chunks that end at a gap, so the arrays stay small for texts of any length; only a
    single word is never cut.
    """
    texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]] if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    first_of_text = np.zeros(len(data) + 1, dtype=bool)
    first_of_text[offsets[:-1]] = True
    hashes, starts, stops, at = [], [], [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        while end < len(data):  # to the next boundary of a word
            step = data[end:end + 4096]
            cut = np.flatnonzero(gap[step] | first_of_text[end:end + len(step)])
            if len(cut):
                end += int(cut[0])
                break
            end = min(len(data), end + 4096)
        h, s, e = _chunk(data[at:end], first_of_text[at:end], gap)
        hashes.append(h)
        starts.append(s + at)
        stops.append(e + at)
        at = end
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    stops = np.concatenate(stops) if stops else np.zeros(0, np.int64)
    return hashes, np.searchsorted(starts, offsets, "left"), starts, stops, data, offsets


def _chunk(c: np.ndarray, first: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    up, down = _Powers.upto(len(c) + 1)
    solid = ~gap[c]
    before = np.empty_like(solid)
    before[0] = False
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | first))
    edge = np.empty(len(c) + 1, dtype=bool)  # where a word that runs up to here ends
    edge[0] = False
    edge[1:-1] = solid[:-1] & (~solid[1:] | first[1:])
    edge[-1] = solid[-1] if len(solid) else False
    end = np.flatnonzero(edge)
    lower = c + (((c >= 65) & (c <= 90)).astype(np.uint8) << 5)
    with np.errstate(over="ignore"):
        sums = np.empty(len(c) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_BYTES[lower] * up[:len(c)], out=sums[1:])
        h = (sums[end] - sums[start]) * down[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(_BASE)), start, end


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of runs of bytes, none empty, the same that these bytes have as words."""
    size = end - start
    at = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(at, size)
    c = data[np.repeat(start, size) + place]
    lower = c + (((c >= 65) & (c <= 90)).astype(np.uint8) << 5)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(_BYTES[lower] * _Powers.upto(int(size.max(initial=0)) + 1)[0][place], at) if len(size) else np.zeros(0, np.uint64)
        return mix(sums + size.astype(np.uint64) * np.uint64(_BASE))


def shingle_hashes(words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `size` words of each text and their offsets; a text of fewer words has one, of all its words."""
    counts = np.diff(at)
    n = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    out_at = np.concatenate([[0], np.cumsum(n)])
    keys = seeds(size + 1, 5)
    with np.errstate(over="ignore"):
        text = np.repeat(np.arange(len(n)), n)
        place = np.arange(out_at[-1]) - out_at[text] + at[text]
        last = at[1:][text]
        out = np.zeros(len(place), dtype=np.uint64)
        for k in range(size):
            inside = place + k < last
            out += np.where(inside, words[np.minimum(place + k, max(len(words) - 1, 0))] * keys[k] + keys[size], np.uint64(0)) if len(words) else 0
            out = mix(out)
    return out, out_at
