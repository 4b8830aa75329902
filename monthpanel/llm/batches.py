"""Arrow batches as NumPy arrays and words as hashes, for the operators that work on bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values one after the other, and where each begins and ends (one offset more than values)."""
    array = array.cast(pa.large_binary())
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8), offsets


class _WordHashes(dict):
    """64-bit hashes of words, remembered for some hundred thousand of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


word_hashes = _WordHashes()
