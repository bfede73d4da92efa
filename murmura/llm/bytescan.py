"""Words and hashes of whole texts, a batch at a time, straight from the UTF-8 bytes of an Arrow column.

Every array is as long as a piece of text or its words, so memory follows the
batch and not the partition. Multi-byte characters count as word characters in
both classes below, which lets one byte decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes scanned at once; a longer text is cut between words.
_PIECE = 1 << 20

_ALL = np.arange(256)
_SPACE = np.isin(_ALL, [0x20, *range(0x09, 0x0E)])
_DIGIT = (_ALL >= 0x30) & (_ALL <= 0x39)
_LOWER = (_ALL >= 0x61) & (_ALL <= 0x7A)
_UPPER = (_ALL >= 0x41) & (_ALL <= 0x5A)

# Words between white space; of ASCII letters, digits and any character beyond ASCII; and of the same without digits.
SPACED = ~_SPACE
ALPHANUMERIC = _DIGIT | _LOWER | _UPPER | (_ALL >= 0x80)
LETTERS = _LOWER | _UPPER | (_ALL >= 0x80)

_FOLD = np.where(_UPPER, _ALL + 32, _ALL).astype(np.uint8)
FOLD_BYTES = _FOLD.tobytes()

_SEED = np.random.default_rng(20_240_229)
_BYTE_CODE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[str, np.ndarray] = {"up": _powers(_BASE, 1), "down": _powers(_BASE_INVERSE, 1)}


def _tables_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables["up"]) < n:
        size = max(n, _PIECE + (1 << 16))
        _tables["up"], _tables["down"] = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
    return _tables["up"], _tables["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the published SplitMix64 finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string column and the offsets of each; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


class Words:
    """Words of a batch in order: byte ranges, hashes of their A-Z-folded bytes, and where each text's words begin."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray, fold: bool = True):
        self.raw, self.offsets = raw, offsets
        starts, ends, hashes = [], [], []
        first = np.zeros(len(raw) + 1, dtype=bool)
        first[offsets] = True
        for lo, hi in _pieces(raw, first, kind):
            s, e, h = _scan(raw[lo:hi], first[lo:hi], kind, fold)
            starts.append(s + lo)
            ends.append(e + lo)
            hashes.append(h)
        none = np.zeros(0, np.int64)
        self.starts = np.concatenate(starts) if starts else none
        self.ends = np.concatenate(ends) if ends else none
        self.hashes = np.concatenate(hashes) if hashes else none.astype(np.uint64)
        self.bounds = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def spelled(self, at: np.ndarray) -> pa.Array:
        """The folded words at the given indexes, as strings."""
        lengths = self.ends[at] - self.starts[at]
        ends = np.cumsum(lengths)
        take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - (ends - lengths), lengths)
        body = self.raw[take].tobytes().translate(FOLD_BYTES)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(body))

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``width`` words inside a text, and the index of each run's first word."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for j in range(width):
            total += mix(self.hashes[j : j + n] + np.uint64((j + 1) * int(_BASE) % 2**64))
        owner = self.text_of_word()
        inside = np.flatnonzero(owner[:n] == owner[width - 1 :])
        return mix(total[inside]), inside


def _pieces(raw: np.ndarray, first: np.ndarray, kind: np.ndarray) -> Iterator[tuple[int, int]]:
    lo, n = 0, len(raw)
    while lo < n:
        hi = min(n, lo + _PIECE)
        while hi < n:
            stop = min(n, hi + 65_536)
            gaps = np.flatnonzero(~kind[raw[hi:stop]] | first[hi:stop])
            if len(gaps):
                hi += int(gaps[0])
                break
            hi = stop
        yield lo, hi
        lo = hi


def _scan(raw: np.ndarray, first: np.ndarray, kind: np.ndarray, fold: bool):
    word = kind[raw]
    opens = word.copy()
    opens[1:] &= ~word[:-1] | first[1:]
    closes = word.copy()
    closes[:-1] &= ~word[1:] | first[1:]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = _tables_for(len(raw) + 1)
    summed = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[_FOLD[raw] if fold else raw] * up[: len(raw)], out=summed[1:])
    return starts, ends, mix((summed[ends] - summed[starts]) * down[starts])


def words(column: pa.Array, kind: np.ndarray, fold: bool = True) -> Words:
    return Words(*utf8(column), kind, fold)


def row_blocks(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes of text; a longer text comes alone."""
    if not batch.num_rows:
        return
    _, offsets = utf8(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi
