"""Sets of word shingles as sorted 64-bit hashes, for Python workers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from statflow.llm.wordhash import mix

WORDS = 5
#: Odd multipliers, one per word of a shingle.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                   0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def shingle_sets(block) -> Iterator[np.ndarray]:
    """For each text of a block the sorted different hashes of its shingles
    (lower-cased A-Z; all words as one shingle where there are fewer)."""
    starts, ends, first = block.words()
    h = block.hashes(block.rolled(), starts, ends)
    n = len(h)
    whole = np.zeros(n, np.uint64)
    for k in range(WORDS):
        whole[:n - k] += h[k:] * PLACES[k] if n > k else 0
    whole = mix(whole)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= WORDS:
            yield np.unique(whole[a:b - WORDS + 1])
        elif b > a:
            short = (h[a:b] * PLACES[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield mix(np.array([short], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
