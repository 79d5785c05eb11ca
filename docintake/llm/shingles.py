"""Word shingles of whole texts as sorted 64-bit numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from docintake.llm.common import ranges, texts_of
from docintake.llm.fragments import starts_of_texts

SHINGLE_WORDS = 5

# Fixed odd multipliers, from the golden ratio and a public 64-bit mixer.
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, text after text, and the number of words of each text.

    Words are what stands between blanks, with A-Z lower-cased.
    """
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    upper = (data >= 0x41) & (data <= 0x5A)
    lowered = data + (upper.astype(np.uint8) << 5)
    begins = ~blank
    begins[1:] &= blank[:-1] | starts_of_texts(len(data), bounds)[1:]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds) - 1, np.int64)
    # Without blanks, words lie one after the other.
    place = np.cumsum(~blank) - 1
    letters = np.ascontiguousarray(lowered[~blank])
    offsets = np.append(place[starts], len(letters)).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    known = [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()]
    hashes = np.array(known, np.uint64)[coded.indices.to_numpy()]
    return hashes, np.diff(np.searchsorted(starts, bounds))


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Per text its distinct shingles of ``size`` words, sorted.

    A text with fewer words has its whole sequence as one shingle, and one without words
    has none.
    """
    data, bounds = texts_of(texts)
    words, counts = words_of(data, bounds)
    n = np.maximum(counts - size + 1, np.minimum(counts, 1))
    first = np.cumsum(counts) - counts
    at = ranges(first, n)
    total = np.zeros(len(at), np.uint64)
    length = np.repeat(np.minimum(counts, size), n)
    for k in range(size):
        here = k < length
        total[here] = total[here] * STEP + mixed(words[at[here] + k] + np.uint64(k + 1))
    total = mixed(total + length.astype(np.uint64) * MIX_2)
    sets, done = [], 0
    for m in n.tolist():
        found = np.sort(total[done : done + m])
        done += m
        if m > 1:
            found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        sets.append(found)
    return sets


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[place] == a).sum())
