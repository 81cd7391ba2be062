"""64-bit hashes of the words of whole texts, for Python workers: numpy over
the UTF-8 bytes of an Arrow column, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from statflow.llm.tokens import worker_store

#: Bytes of text worked on at a time (a longer text is worked on alone).
BLOCK = 1 << 20
#: Multiplier of the rolling hash, its inverse mod 2^64, and the
#: multipliers of the final mix.
ROLL = 0x9E3779B97F4A7C15
ROLL_INVERSE = pow(ROLL, -1, 1 << 64)
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of ``h`` over all bits (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX_1)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX_2)
    return h ^ (h >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(ROLL))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: For words without punctuation: all but ASCII letters, digits and bytes of
#: other characters separate.
IS_PUNCTUATION = np.ones(256, dtype=bool)
IS_PUNCTUATION[48:58] = IS_PUNCTUATION[65:91] = IS_PUNCTUATION[97:123] = False
IS_PUNCTUATION[128:] = False


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def make(size: int):
        return tuple(np.concatenate([np.ones(1, np.uint64),
                                     np.cumprod(np.full(size, x, dtype=np.uint64))])
                     for x in (ROLL, ROLL_INVERSE))

    if n <= BLOCK:
        both = worker_store("roll_powers", lambda: make(BLOCK))
        return both[0][:n + 1], both[1][:n + 1]
    return make(n)


class Block:
    """Consecutive texts ``lo``..``hi`` of a column: bytes and text bounds."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lo: int, hi: int):
        self.lo, self.hi = lo, hi
        self.data = data[bounds[lo]:bounds[hi]]
        self.bounds = bounds[lo:hi + 1] - bounds[lo]

    def words(self, separators: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of the words, and the number of the first word
        of each text (with one more entry: the number of words)."""
        inside = ~separators[self.data]
        new = np.zeros(len(inside) + 1, dtype=bool)
        new[self.bounds] = True  # words do not run on into the next text
        before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
        after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
        starts = np.flatnonzero(inside & (~before | new[:-1]))
        ends = np.flatnonzero(inside & (~after | new[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)

    def rolled(self) -> np.ndarray:
        """Running sums from which :meth:`hashes` makes the hash of any span,
        with A-Z lower-cased."""
        out = np.zeros(len(self.data) + 1, np.uint64)
        np.take(BYTE_CODES, LOWER[self.data], out=out[1:], mode="clip")  # else a copy is made
        up, _ = _powers(len(self.data))
        out[1:] *= up[:-1]
        return np.cumsum(out, out=out)

    @staticmethod
    def hashes(rolled: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, down = _powers(len(rolled) - 1)
        return mix((rolled[ends] - rolled[starts]) * down[starts])


def blocks(column) -> Iterator[Block]:
    """The texts of an Arrow string column (NULL: empty), block by block."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    _, offsets, values = column.buffers()
    bounds = (np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
              if n else np.zeros(1, np.int64))
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + BLOCK, side="right")) - 1)
        yield Block(data, bounds, lo, min(hi, n))
        lo = min(hi, n)
