"""Words of Arrow text columns as numpy arrays: no Python object per word.

A batch of texts is looked at as one run of bytes. Word borders come from a table of
separator bytes, word hashes from a sum over the bytes of each word, so the cost per
byte is a few vector operations whatever the words are.
"""

import ctypes

import numpy as np
import pyarrow as pa


def release() -> None:
    """Gives memory that a batch needed back to the system: workers live on and wait for other work."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


PIECE_ENDS = [*b".,;:!?", 10, 11, 12, 13]


def separators(keep: str) -> np.ndarray:
    """256 flags: which bytes end a word. ``blank``: white space only; ``punct``: all but letters and digits;
    ``letters``: all but letters and what isn't ASCII; ``pieces``: blanks, and what ends a piece of a sentence."""
    flags = np.zeros(256, bool)
    if keep == "letters":
        flags[:128] = [not chr(b).isalpha() for b in range(128)]
    elif keep == "pieces":
        flags[[9, 32]] = flags[PIECE_ENDS] = True
    elif keep == "blank":
        flags[[9, 10, 11, 12, 13, 32]] = True
    else:
        flags[:128] = [not chr(b).isalnum() for b in range(128)]
    return flags


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_STEP = 0xD1342543DE82EF95


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _STEP, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int, most_rows: int = 60_000):
    """Row slices of a batch with at most so many bytes of text each (one row at least)."""
    offsets, _ = _offsets(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets[1:], offsets[at] + most_bytes, side="right"))
        to = min(max(to, at + 1), at + most_rows, batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def _offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]: offsets[-1]]


class Borders:
    """Words of some texts: ``text`` (row of each word), ``start`` and ``end`` (bytes in ``data``)."""

    def __init__(self, column: pa.Array, flags: np.ndarray):
        self.offsets, self.data = _offsets(column)
        self.black = black = ~flags[self.data]
        begins = self.offsets[:-1][self.offsets[:-1] < len(self.data)]
        first = black.copy()
        first[1:] &= ~black[:-1]
        first[begins] = black[begins]
        last = black.copy()
        last[:-1] &= ~black[1:]
        tails = self.offsets[1:][self.offsets[1:] > 0] - 1
        last[tails] = black[tails]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.text = np.searchsorted(self.offsets, self.start, side="right") - 1

    def lowered(self) -> np.ndarray:
        """The bytes with A-Z in lower case."""
        return self.data + (((self.data >= 65) & (self.data <= 90)).astype(np.uint8) << 5)


class Words(Borders):
    """Words with their ``hash``."""

    def __init__(self, column: pa.Array, flags: np.ndarray):
        super().__init__(column, flags)
        self.hash = self._hashes(self.black)
        del self.black

    def _hashes(self, black: np.ndarray) -> np.ndarray:
        """In runs of about a million bytes (at least one word), which bounds the memory."""
        out = np.zeros(len(self.start), np.uint64)
        a = 0
        while a < len(out):
            b = max(a + 1, int(np.searchsorted(self.start, self.start[a] + (1 << 20))))
            lo, hi = int(self.start[a]), int(self.end[b - 1])
            start = self.start[a:b] - lo
            spans = np.diff(np.append(start, hi - lo))
            value = _BYTE[self.data[lo:hi]]
            value[~black[lo:hi]] = 0
            value *= _powers(int(spans.max()))[np.arange(hi - lo) - np.repeat(start, spans)]
            size = (self.end[a:b] - self.start[a:b]).astype(np.uint64)
            out[a:b] = mix(np.add.reduceat(value, start) + size * np.uint64(0x9E3779B97F4A7C15))
            a = b
        return out

    def per_text(self) -> np.ndarray:
        return np.bincount(self.text, minlength=len(self.offsets) - 1)


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The texts that lie between these places of the bytes."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    found = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at]))
    return found.cast(pa.string())


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``size`` words; a text of fewer words is one shingle of its own kind."""
    n, h, text = words.per_text(), words.hash, words.text
    found_text, found = [], []

    def run(at: np.ndarray, k: int) -> None:
        if not len(at):
            return
        value = np.full(len(at), k, np.uint64)
        for j in range(k):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + h[at + j])
        found_text.append(text[at])
        found.append(value)

    if len(h) >= size:
        at = np.flatnonzero(text[: len(h) - size + 1] == text[size - 1:])
        run(at, size)
    first = np.cumsum(n) - n
    for k in range(1, size):
        run(first[n == k], k)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(found_text), np.concatenate(found)
