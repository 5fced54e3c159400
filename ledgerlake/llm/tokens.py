"""Whole texts to token ids with a vocabulary file of the tokenizers library.

Both vocabularies used here split a text into words before any merge, and no
word crosses the start of a space that has a non-space on either side.  So a
text is cut there, and the ids of the first pieces and words are kept: a corpus
repeats its words, and the library is asked once per new one.  Pieces are looked
up and cut into words as whole Arrow arrays, but for those that are more than
letters and closing marks.  Pieces with characters past Latin Extended-B, and
whole texts that hold the string of a special token or a space between white
space, go to the library as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# How the two vocabularies split a text into words.
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LOWER_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

LAST_PLAIN = "\u024f"
WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNSAFE_SPACE = rf"{WHITE} (?:{WHITE}|\z)"
# UTF-8 bytes from this one on begin characters past Latin-1.
PAST_LATIN_1 = 0xC4
MARKS = ".,;:!?"
EMPTY, SPACE = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
# What a worker remembers, at most and of how many bytes on average.
CACHED_PIECES, CACHED_WORDS, CACHED_BYTES = 300_000, 500_000, 32
# Texts encoded at once: the more, the fewer times a word is looked up, and the more memory a batch takes.
TEXTS = 1024


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as one printable character:
    printable Latin-1 bytes as themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def bounds_of(strings: pa.Array) -> np.ndarray:
    """Where each of large strings starts in their bytes, and where the last one ends."""
    return np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]


def bytes_of(strings: pa.Array) -> np.ndarray:
    data = strings.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def strings_of(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


def gathered(flat: np.ndarray, begin: np.ndarray, each: np.ndarray) -> np.ndarray:
    """The runs of ``each`` values that begin at ``begin``, end to end."""
    ahead = np.cumsum(each) - each
    at = np.repeat(begin - ahead, each)
    at += np.arange(len(at))
    return flat[at]


class Ids:
    """The ids of strings: end to end in ``flat``, ``size`` of each."""

    def __init__(self, flat: np.ndarray, size: np.ndarray):
        self.flat, self.size = flat, size

    @staticmethod
    def of(ids: list[list[int]]) -> Ids:
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return Ids(np.fromiter(chain.from_iterable(ids), np.uint16, int(size.sum())), size)

    def __add__(self, more: Ids) -> Ids:
        return Ids(np.concatenate([self.flat, more.flat]), np.concatenate([self.size, more.size]))

    def __getitem__(self, at: np.ndarray | slice) -> Ids:
        if isinstance(at, slice):  # the first ones
            return Ids(self.flat[:int(self.size[at].sum())].copy(), self.size[at].copy())
        each = self.size[at]
        return Ids(gathered(self.flat, (np.cumsum(self.size) - self.size)[at], each), each)


class Known:
    """Remembers the ids of the first ``most`` strings that it meets."""

    def __init__(self, most: int, make: Callable[[pa.Array], Ids]):
        self.most, self.make = most, make
        self.places: dict[str, int] = {}
        self.bytes, self.ids = 0, Ids.of([])

    @property
    def strings(self) -> pa.Array:
        return pa.array(list(self.places), pa.large_string())

    def look(self, strings: pa.Array) -> tuple[np.ndarray, Ids]:
        """The place of each string among some, and the ids of those."""
        coded = strings.dictionary_encode()
        at, found = coded.indices.to_numpy(), strings_of(coded.dictionary)
        n, places = len(self.places), np.fromiter(map(self.places.get, found, repeat(-1)), np.int64, len(found))
        new = np.flatnonzero(places < 0)
        if not len(new):
            return places[at], self.ids
        asked = coded.dictionary.take(pa.array(new))
        places[new] = n + np.arange(len(new))
        ids = self.ids + self.make(asked)
        until = bounds_of(asked) + self.bytes
        keep = min(self.most - n, int(np.searchsorted(until, CACHED_BYTES * self.most, "right")) - 1)
        if keep > 0:
            self.places.update(zip((found[i] for i in new[:keep].tolist()), range(n, n + keep)))
            self.bytes, self.ids = int(until[keep]), ids[:n + keep]
        return places[at], ids


class Encoder:
    """Ids of whole texts.  ``lower``: the vocabulary drops white space and
    case, so a leading space makes no difference."""

    def __init__(self, path: str, lower: bool):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.normalizer = self.tokenizer.normalizer
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lower = lower
        self.words = regex.compile(LOWER_WORDS if lower else BYTE_WORDS)
        self.letters = byte_letters()
        self.of_piece = Known(CACHED_PIECES, self._of_pieces)
        self.of_word = Known(CACHED_WORDS, self._of_words)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (``uint16``); a null text has none."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        whole = np.zeros(len(texts), bool)
        for s in self.special:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        if not self.lower:
            whole |= pc.match_substring_regex(texts, UNSAFE_SPACE).to_numpy(zero_copy_only=False)
        rest = pc.if_else(pa.array(whole), "", texts) if whole.any() else texts
        out = self._by_piece(rest)
        for i in np.flatnonzero(whole):
            out[i] = np.array(self._library(texts[int(i)].as_py()), "<u2")
        pa.default_memory_pool().release_unused()  # a batch's arrays, some 100 MB
        return out

    def _by_piece(self, texts: pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        if self.lower:
            texts = pc.ascii_lower(pc.replace_substring(texts, "\n", " "))
        pieces = pc.split_pattern(texts, " ")
        starts = pieces.offsets.to_numpy()[:-1] - pieces.offsets[0].as_py()
        pieces = pieces.flatten()
        if self.lower:
            at, ids = self.of_piece.look(pieces)
        else:  # a text's first piece has no space before it; only its key has one
            first = pc.binary_join_element_wise(EMPTY, pieces.take(pa.array(starts)), SPACE)
            at, ids = self.of_piece.look(pa.concat_arrays([pieces, first]))
            at, of_first = at[:len(pieces)], at[len(pieces):]
            at[starts] = of_first
        ids = ids[at]
        return np.split(ids.flat, (np.cumsum(ids.size) - ids.size)[starts][1:])

    def _of_pieces(self, pieces: pa.Array) -> Ids:
        n = len(pieces)
        bounds, data = bounds_of(pieces), bytes_of(pieces)
        past = np.r_[0, np.cumsum(data[bounds[0]:bounds[-1]] >= PAST_LATIN_1)][bounds - bounds[0]]
        body = pc.utf8_rtrim(pieces, MARKS)
        simple = pc.utf8_is_alpha(body).to_numpy(zero_copy_only=False) & (past[1:] == past[:-1])
        own = np.flatnonzero(simple)
        marks = np.diff(bounds) - np.diff(bounds_of(body))
        marked = np.flatnonzero(simple & (marks > 0))
        tails = pa.LargeStringArray.from_buffers(len(marked), pa.py_buffer(np.r_[0, np.cumsum(marks[marked])]), pa.py_buffer(
            gathered(data, bounds[1:][marked] - marks[marked], marks[marked])))
        body = body.take(pa.array(own))
        words = pc.utf8_lower(body) if self.lower else pc.binary_join_element_wise(EMPTY, body, SPACE)
        # the others' words, one piece at a time; or all ids, where only the library knows
        odd, odd_words, asked, asked_ids = [], [], [], []
        rest = np.flatnonzero(~simple)
        for i, key in zip(rest.tolist(), strings_of(pieces.take(pa.array(rest)))):
            piece = key if self.lower else key[1:] if key[:1] == " " else " " + key
            found = self._words(piece)
            if found is None:
                asked.append(i)
                asked_ids.append(self._library(piece))
            else:
                odd.extend([i] * len(found))
                odd_words.extend(found)
        at, ids = self.of_word.look(pa.concat_arrays([words, tails, pa.array(odd_words, pa.large_string())]))
        at = np.r_[at, len(ids.size) + np.arange(len(asked))]
        owner = np.concatenate([own, marked, np.array(odd + asked, np.int64)])
        order = np.argsort(owner, kind="stable")
        ids = (ids + Ids.of(asked_ids))[at[order]]
        return Ids(ids.flat, np.bincount(owner[order], ids.size, minlength=n).astype(np.int64))

    def _words(self, piece: str) -> list[str] | None:
        """The words of a piece; None: only the library knows."""
        if not piece.isascii() and max(piece) > LAST_PLAIN:
            return None
        if self.lower and not piece.isascii():
            piece = self.normalizer.normalize_str(piece)
        return self.words.findall(piece)

    def _of_words(self, words: pa.Array) -> Ids:
        tokenize, own = self.model.tokenize, strings_of(words)
        body = pc.utf8_ltrim(words, " ")
        simple = pc.and_(pc.string_is_ascii(body), pc.utf8_is_alpha(body)).to_numpy(zero_copy_only=False).tolist()
        spelled = own if self.lower else strings_of(pc.replace_substring(words, " ", self.letters[32]))
        return Ids.of([[t.id for t in tokenize(s if plain else self._spelled(w))] for plain, s, w in zip(simple, spelled, own)])

    def _spelled(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.letters)

    def _library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=1)
def encoder(path: str, lower: bool) -> Encoder:
    """One per Python worker, which serves many tasks; another vocabulary takes its place."""
    pa.default_memory_pool().release_unused()  # what an earlier job's batches have left
    return Encoder(path, lower)


def forget() -> None:
    """Give back what an earlier job's vocabulary and batches have left in this Python worker, some 200 MB."""
    encoder.cache_clear()
    pa.default_memory_pool().release_unused()
