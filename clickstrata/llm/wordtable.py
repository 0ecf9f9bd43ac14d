"""The words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes handled at once; a longer text is handled alone.
AT_ONCE = 1 << 20

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
# ASCII letters and digits, white space, and all other scripts.
PLAIN = np.zeros(256, dtype=bool)
PLAIN[128:] = True
PLAIN[list(b"0123456789abcdefghijklmnopqrstuvwxyz\t\n\x0b\x0c\r ")] = True

_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2)
_BYTE += np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = np.multiply.accumulate(np.full(n, _STEP, dtype=np.uint64))
            self.down = np.multiply.accumulate(np.full(n, _STEP_BACK, dtype=np.uint64))
        return self.up, self.down


_powers = _Powers()


@dataclass
class Texts:
    """Some rows of a batch: all bytes in a row, and where each text begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def chars_before(self) -> np.ndarray:
        """Code points that begin before each byte; subtract the text's own start."""
        begins = (self.data & 0xC0) != 0x80
        return np.concatenate([[0], np.cumsum(begins)])


def texts_of(batch: pa.RecordBatch, column: str = "text", at_once: int = AT_ONCE) -> Iterator[Texts]:
    """The texts of a batch in runs of bounded size; null as empty."""
    strings = batch.column(column)
    if strings.null_count:
        strings = strings.fill_null("")
    strings = strings.cast(pa.large_string())
    if not len(strings):
        return
    _, where, data = strings.buffers()
    ends = np.frombuffer(where, dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(strings):
        last = int(np.searchsorted(ends, ends[first] + at_once, side="left"))
        last = min(max(last, first + 1), len(strings))
        yield Texts(
            first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        )
        first = last


@dataclass
class Words:
    """Bytes, and for each word its range there, its row, and its hash."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    hashes: np.ndarray
    # Place of each byte of ``data`` in the text's own bytes; None if the same.
    places: np.ndarray | None
    # Number of the first word of each row, and after the last.
    bounds: np.ndarray

    def string(self, word: int) -> bytes:
        return self.data[self.starts[word] : self.ends[word]].tobytes()

    def joined(self, row: int) -> bytes:
        """The words of a row with single spaces, one at each end."""
        a, b = self.bounds[row], self.bounds[row + 1]
        return b" ".join([b"", *(self.string(w) for w in range(a, b)), b""])


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each range of bytes."""
    n = len(data)
    up, down = _powers.to(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:n])])
    own = (sums[ends] - sums[starts]) * down[starts]
    return mixed(own ^ (ends - starts).astype(np.uint64) * _STEP)


def words_of(texts: Texts, lower: bool = False, plain: bool = False) -> Words:
    """Words between white space; lower: A-Z as a-z; plain: lower, only letters and digits."""
    data, offsets, places = texts.data, texts.offsets, None
    if lower or plain:
        data = LOWERED[data]
    if plain:
        keep = PLAIN[data]
        kept = np.concatenate([[0], np.cumsum(keep)])
        places = np.flatnonzero(keep)
        data, offsets = data[keep], kept[offsets]
    n = len(data)
    solid = ~WHITE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:n]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    bounds = np.searchsorted(rows, np.arange(len(texts) + 1))
    return Words(data, starts, ends, rows, hashes(data, starts, ends), places, bounds)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of n words within a row, and the run's first word."""
    if len(words.hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(words.rows[: len(words.rows) - n + 1] == words.rows[n - 1 :])
    total = np.full(len(first), n, dtype=np.uint64)
    for k in range(n):
        total = mixed(total * _STEP + words.hashes[first + k])
    return total, first
