"""Texts cut where no tokenizer looks across, so that a fragment is encoded only once.

Library tokenizers spend their time in merges, and words recur. A text is cut at places
where its tokens are known to end; each distinct fragment of a chunk goes through the
library, and its ids are laid out again in the order of the text.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docintake.llm.common import ranges, texts_of

# Fragments that a Python worker keeps before it lets go of those not asked for since.
MEMORY = 300_000

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = range(5)

# Unicode's White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E),
    0x20,
    0x85,
    0xA0,
    0x1680,
    *range(0x2000, 0x200B),
    0x2028,
    0x2029,
    0x202F,
    0x205F,
    0x3000,
)


# Fixed values of UTF-8: range of the first byte, bytes, and the first byte's share.
LEADS = ((0xC0, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F), (0xF0, 0xF8, 4, 0x07))


@lru_cache(maxsize=1)
def known_classes() -> np.ndarray:
    """The class of every code point met so far, UNKNOWN for others."""
    table = np.full(0x110000, UNKNOWN, np.uint8)
    table[:0x80] = OTHER
    for low, high, kind in (("a", "z", LETTER), ("A", "Z", LETTER), ("0", "9", NUMBER)):
        table[ord(low) : ord(high) + 1] = kind
    table[list(WHITE_SPACE)] = SPACE
    return table


@lru_cache(maxsize=1)
def splitter():
    from tokenizers import pre_tokenizers

    return pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)


def char_class(points: np.ndarray) -> np.ndarray:
    """Classes of code points. One not met before is shown to the library between two
    letters and between two digits: it is what does not part from them."""
    table = known_classes()
    for point in np.unique(points[table[points] == UNKNOWN]):
        sign = chr(point)
        pieces = [span for _, span in splitter().pre_tokenize_str(f"a{sign}a1{sign}1")]
        letter, number = pieces[0] == (0, 3), pieces[-1] == (3, 6)
        table[point] = LETTER if letter else NUMBER if number else OTHER
    return table[points]


def starts_of_texts(size: int, bounds: np.ndarray) -> np.ndarray:
    """A mark for each byte: whether a text starts there."""
    marks = np.zeros(size, bool)
    marks[bounds[:-1][np.diff(bounds) > 0]] = True
    return marks


def classes_of(data: np.ndarray) -> np.ndarray:
    """The class of each byte; all bytes of a UTF-8 character have the character's."""
    kind = known_classes()[data]
    for low, high, width, bits in LEADS:
        lead = np.flatnonzero((data >= low) & (data < high))
        lead = lead[lead + width <= len(data)]
        point = (data[lead] & bits).astype(np.int64)
        for k in range(1, width):
            point = point << 6 | (data[lead + k] & 0x3F)
        found = char_class(np.minimum(point, 0x10FFFF))
        for k in range(width):
            kind[lead + k] = found
    return kind


def mark_pretokens(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A mark for each byte: whether a match of ``public_tokenizers.PATTERN`` starts there.

    A match is a run of letters, of numbers or of other signs, with one blank before it if
    there is one; the rest of a run of white space is a match of its own. A lone apostrophe
    that starts a match takes one of the endings s t re ve m ll d along.
    """
    first = starts_of_texts(len(data), bounds)
    if not len(data):
        return first
    kind = classes_of(data)
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    run = start.copy()

    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:])
    blank = data[last] == 0x20
    start[last[blank]] = True
    start[last[blank] + 1] = False
    for i in last[~blank]:  # a white space other than a blank is a match by itself
        while data[i] & 0xC0 == 0x80:
            i -= 1
        start[i] = True

    quote = np.flatnonzero(data == 0x27)
    quote = quote[quote + 1 < len(data)]
    quote = quote[start[quote] & run[quote] & ~first[quote + 1]]
    c1 = data[quote + 1]
    third = np.minimum(quote + 2, len(data) - 1)
    c2 = np.where((quote + 2 < len(data)) & ~first[third], data[third], 0)
    e, r, v, el = b"ervl"
    two = ((c1 == r) & (c2 == e)) | ((c1 == v) & (c2 == e)) | ((c1 == el) & (c2 == el))
    one = np.isin(c1, np.frombuffer(b"stmd", np.uint8))
    length = np.where(one, 1, 2)[one | two]
    quote = quote[one | two]
    start[quote + 1] = False
    after = quote + 1 + length
    start[after[after < len(start)]] = True
    return start


def cut_pretokens(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.flatnonzero(mark_pretokens(data, bounds))


def cut_words(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of fragments for a tokenizer that composes and lower-cases before it splits.

    Of the places of ``cut_pretokens`` those stay where neither can reach across: between
    an ASCII or Latin-1 letter and an ASCII character, but neither behind an apostrophe nor
    within a run of letters.
    """
    marks = mark_pretokens(data, bounds)
    if len(data) > 1:
        before, after = data[:-1], data[1:]
        plain = before < 0x80
        plain[1:] |= data[:-2] == 0xC3
        letter = known_classes()[data] == LETTER
        letter[1:] |= before == 0xC3
        marks[1:] &= plain & (before != 0x27) & (after < 0x80) & ~(letter[:-1] & letter[1:])
    return np.flatnonzero(marks | starts_of_texts(len(data), bounds))


def fragment_array(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    if not len(starts):
        return pa.array([], pa.string())
    offsets = np.append(starts, len(data)).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.string(), len(starts), buffers)


@lru_cache(maxsize=4)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes
    stand for themselves, the others are numbered from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Memory:
    """The ids of fragments seen lately, as bytes; forgets those not asked for since a while."""

    def __init__(self, most: int | None = None) -> None:
        self.most = MEMORY if most is None else most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def codes(self, words: list[str], encode) -> list[bytes]:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = list(map(young.get, words))
        for i, code in enumerate(found):
            if code is None:
                word = words[i]
                code = old.get(word)
                found[i] = young[word] = encode(word) if code is None else code
        return found


class TextEncoder:
    """Ids of whole texts by the tokenizers library, with every distinct fragment encoded once.

    The ids are those of ``encode(text, add_special_tokens=False)``. Fragments that are one
    word of the vocabulary's model go straight to the model, others through the whole
    tokenizer, and so do whole texts that contain the string of a special token.
    """

    def __init__(self, path: str, most: int | None = None):
        self.tokenizer = library(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memory = Memory(most)
        self.lower = self.tokenizer.normalizer is not None
        self.cut = cut_words if self.lower else cut_pretokens
        self.encode_fragment = self.lower_word if self.lower else self.byte_word

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def by_model(self, word: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(word)]).tobytes()

    def byte_word(self, fragment: str) -> bytes:
        letters = fragment.encode().decode("latin-1").translate(byte_letters())
        return self.by_model(letters)

    def lower_word(self, fragment: str) -> bytes:
        word = fragment.strip(" ")
        if word.isascii() and word.isalpha():  # such letters stand for themselves
            return self.by_model(word.lower())
        if word.isalpha() and max(word) < "\u0100":  # Latin-1 letters are composed already
            return self.byte_word(word.lower())
        return self.whole(fragment)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        odd = np.zeros(len(texts), bool)
        for token in self.special:
            found = pc.match_substring(texts, token).fill_null(False)
            odd |= found.to_numpy(zero_copy_only=False)
        if not odd.any():
            return self.encode_plain(texts)
        ids, counts = self.encode_plain(pc.if_else(pa.array(odd), pa.scalar("", texts.type), texts))
        ends = np.cumsum(counts)
        parts, done = [], 0
        for i in np.flatnonzero(odd):
            parts += [ids[done : ends[i]], np.frombuffer(self.whole(texts[i].as_py()), self.dtype)]
            counts[i], done = len(parts[-1]), ends[i]
        return np.concatenate([*parts, ids[done:]]), counts

    def encode_plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, bounds = texts_of(texts)
        starts = self.cut(data, bounds)
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(len(bounds) - 1, np.int64)
        coded = fragment_array(data, starts).dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = self.memory.codes(words, self.encode_fragment)
        size = np.fromiter(map(len, codes), np.int64, len(codes)) // self.dtype.itemsize
        pool = np.frombuffer(b"".join(codes), self.dtype)
        which = coded.indices.to_numpy()
        lengths = size[which]
        ids = pool[ranges((np.cumsum(size) - size)[which], lengths)]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(total[np.searchsorted(starts, bounds)])


@lru_cache(maxsize=2)
def text_encoder(path: str, most: int | None = None) -> TextEncoder:
    return TextEncoder(path, most)
