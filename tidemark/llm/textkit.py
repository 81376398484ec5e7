"""Vectorised byte-level text helpers used inside Arrow tasks.

Texts are handled as UTF-8 bytes. Words are maximal runs of bytes outside
``[\\x20\\x09-\\x0D]``; ``A-Z`` is lower-cased on request. Hashes are 64-bit: a
polynomial over the bytes, finished with a mixer, so equal byte strings have
equal hashes wherever they stand. A batch is cut into slices of about
``SLICE`` bytes (one document at least), which bounds the working memory of a
task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SYMBOL = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Cache(dict):
    """A dictionary of derived values that travels to the workers empty."""

    def __reduce__(self):
        return Cache, ()


_powers = Cache()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base, and of its inverse."""
    size = max(SLICE + 4096, 1 << int(n).bit_length())
    if size not in _powers:
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _BASE_INV, np.uint64)
        up[0] = down[0] = 1
        _powers.clear()
        _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    up, down = _powers[size]
    return up[:n], down[:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums H with H[j] - H[i] the (unshifted) hash of buf[i:j]."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_SYMBOL[buf] * powers(len(buf))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free 64-bit hashes of the spans [start, end)."""
    down = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive parts of a string column."""
    buf, off = text_bytes(column)
    first, n = 0, len(off) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(off, off[first] + size, "right")) - 1)
        yield first, end, buf[off[first] : off[end]], off[first : end + 1] - off[first]
        first = end


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of all words; words never cross documents."""
    if not len(buf):
        return (np.zeros(0, np.int64),) * 3
    solid = ~SPACE[buf]
    head, tail = solid.copy(), solid.copy()
    head[1:] &= ~solid[:-1]
    tail[:-1] &= ~solid[1:]
    filled = off[:-1] < off[1:]
    head[off[:-1][filled]] = solid[off[:-1][filled]]
    tail[off[1:][filled] - 1] = solid[off[1:][filled] - 1]
    start, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def word_hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of lower-cased (A-Z) texts, and the number of words per document."""
    start, end, doc = words(buf, off)
    return span_hash(prefix_hash(LOWER[buf]), start, end), np.bincount(doc, minlength=len(off) - 1)


_STEPS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(hashes: np.ndarray, count: np.ndarray, width: int) -> list[np.ndarray]:
    """Per document its distinct shingles as sorted hashes.

    A document of fewer words has its whole sequence as the one shingle; a
    document without words has none.
    """
    n = len(hashes)
    full = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        full += hashes[k : k + len(full)] * _STEPS[k]
    full = mix(full)
    out, at = [], 0
    for c in count.tolist():
        if c >= width:
            out.append(np.unique(full[at : at + c - width + 1]))
        elif c:
            out.append(mix((hashes[at : at + c] * _STEPS[:c]).sum(keepdims=True) + np.uint64(c)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def binary(chunks: list[bytes]) -> pa.Array:
    return pa.array(chunks, pa.binary())
