"""Token ids of whole texts with public tokenizer files."""

from __future__ import annotations

import json
import sys
from collections.abc import Callable
from types import ModuleType

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from tokenizers import Tokenizer

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Words after which a task starts a new generation of what it remembers; one older generation is kept.
REMEMBERED = 300_000
#: Bytes of texts cut together.
TOGETHER = 1 << 21


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as the letters from code point 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_encoder(path: str = BYTE_BPE) -> Callable[[str], list[int]]:
    """Text to the ids that the tokenizers library gives for a byte-level BPE file, without special tokens added.

    The merges of such a file are in order of their ids, so a faster encoder of the same ranks does the work; what it
    cannot take (a run of white space too long for its pattern) goes to the library itself.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = byte_of_letter()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    slow = Tokenizer.from_file(path)

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except Exception:
            return slow.encode(text, add_special_tokens=False).ids

    return encode


def kept_by_worker(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in a worker process: functions come to it by value with each task, modules stay."""
    store = sys.modules.setdefault("acervo_worker_store", ModuleType("acervo_worker_store")).__dict__.setdefault("made", {})
    if key not in store:
        store[key] = make()
    return store[key]


class Remembered(dict):
    """Answers of a function, made when first asked for; those of an older generation are taken over when they are asked for again."""

    def __init__(self, make: Callable[[bytes], np.ndarray], older: dict[bytes, np.ndarray] | None = None) -> None:
        self.make, self.older = make, older or {}

    def __missing__(self, word: bytes) -> np.ndarray:
        found = self.older.get(word)
        found = self[word] = self.make(word) if found is None else found
        return found


class WordEncoder:
    """Ids of a BPE with word ends that drops white space and looks at nothing beyond it.

    Plain Latin words, whose case and letters every Unicode version agrees on, are cut here, those of many texts together, and merged in one call: the
    merges of the file are in order of their ids, and a space, which no piece of a word has, stands for its end. All others go to
    the tokenizers library, each distinct one once.
    """

    #: Letters before this one are plain Latin; none of them composes with another.
    BEYOND = 0x250
    SPACE, LETTER, DIGIT, OTHER, ODD = range(5)

    def __init__(self, path: str = WORD_BPE) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_of_letter()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        suffix = spec["model"]["end_of_word_suffix"]
        ranks, self.closes = {}, np.zeros(max(spec["model"]["vocab"].values()) + 1, bool)
        for token, i in spec["model"]["vocab"].items():
            if token not in special:
                body = token.removesuffix(suffix)
                self.closes[i] = body != token
                ranks[bytes(letters[c] for c in body) + (b" " if body != token else b"")] = i
        self.merge = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens=special)
        plain = list(map(chr, range(self.BEYOND)))
        kinds = [next((k for k, p in enumerate((r"\s", r"\p{L}", r"\p{N}")) if regex.match(p, c)), self.OTHER) if len(c.lower()) == 1 else self.ODD for c in plain]
        self.kinds = np.array([*kinds, self.ODD], np.uint8)
        self.lower = np.array([*(ord(c.lower()[0]) for c in plain), self.BEYOND], np.uint16)
        self.known = Remembered(self.ids_of)

    def ids_of(self, word: bytes) -> np.ndarray:
        """The ids of one word, by the library."""
        return np.array(self.tokenizer.encode(word.decode("utf-16-le"), add_special_tokens=False).ids, np.uint32)

    def contractions(self, units: np.ndarray, kind: np.ndarray, cut: np.ndarray) -> None:
        """Where a piece begins with an apostrophe, the letters ``s``, ``t``, ``re``, ``ve``, ``m``, ``ll`` or ``d`` after it belong to it and end it."""
        marks = np.flatnonzero((units == ord("'")) & (kind == self.OTHER))
        marks = marks[(marks == 0) | (kind[marks - 1] != self.OTHER)]
        first, second = units[marks + 1], units[np.minimum(marks + 2, len(units) - 1)]
        one = np.isin(first, list(map(ord, "stmd")))
        two = np.isin(first, list(map(ord, "rv"))) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
        cut[marks[one | two]] = False
        cut[marks[one] + 1] = True
        cut[marks[two] + 2] = True

    def merged(self, pieces: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces (UTF-16, a space after each), and their bounds in these; each distinct piece is merged once."""
        bounds = np.concatenate([[0], 2 * ends]).astype(np.int64)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(bounds), pa.py_buffer(pieces)]).dictionary_encode()
        # the values of the dictionary lie one after another
        _, offsets, values = coded.dictionary.buffers()
        distinct = values.to_pybytes()[: np.frombuffer(offsets, np.int64)[len(coded.dictionary)]] if len(ends) else b""
        some = self.merge.encode_to_numpy(distinct.decode("utf-16-le"), disallowed_special=()).astype(np.uint32, copy=False)
        closed = np.concatenate([[0], np.flatnonzero(self.closes.take(some)) + 1])
        which = coded.indices.to_numpy()
        sizes = np.diff(closed).take(which)
        stops = np.cumsum(sizes)
        ids = some.take(np.repeat(closed.take(which) - stops + sizes, sizes) + np.arange(sizes.sum()))
        return ids, np.concatenate([[0], stops])

    def encode_some(self, texts: list[bytes]) -> list[np.ndarray]:
        coded = [t.decode().encode("utf-16-le") + b"\n\0" for t in texts]
        raw = np.frombuffer(b"".join(coded), "<u2")
        units = np.minimum(raw, self.BEYOND)
        kind, units = self.kinds.take(units), self.lower.take(units)
        odd = kind == self.ODD
        odd[:-1] |= (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
        starts, words = np.zeros(0, np.int64), []
        if odd.any():
            breaks = np.concatenate([[-1], np.flatnonzero(kind == self.SPACE)])
            after = np.unique(np.searchsorted(breaks, np.flatnonzero(odd)))
            starts, stops = breaks[after - 1] + 1, breaks[after]
            for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                words.append(self.known[raw[a:b].tobytes()])
                kind[a:b] = self.SPACE
            # one letter holds the place of the word
            kind[starts], units[starts] = self.LETTER, ord("x")
        # a piece ends where the kind changes; digits stand alone
        full = kind != self.SPACE
        cut = kind == self.DIGIT
        cut[:-1] |= full[:-1] & (kind[:-1] != kind[1:])
        self.contractions(units, kind, cut)
        pieces = np.repeat(units, full.view(np.uint8) + cut.view(np.uint8))
        ends = np.flatnonzero(cut[full]) + np.arange(1, np.count_nonzero(cut) + 1)
        pieces[ends] = ord(" ")
        ids, closed = self.merged(pieces, ends + 1)
        first = np.cumsum([0, *map(len, coded[:-1])]) // 2
        stops = closed[np.cumsum(np.add.reduceat(cut, first, dtype=np.int64))]
        if words:
            place = np.cumsum(cut)[starts] - 1
            gone = closed[place]
            longer = np.concatenate([[0], np.cumsum(list(map(len, words))) - np.arange(1, len(words) + 1)])
            parts = np.split(ids, gone)
            ids = np.concatenate([parts[0], *(x for w, p in zip(words, parts[1:], strict=True) for x in (w, p[1:]))])
            stops = stops + longer[np.searchsorted(gone, stops)]
        return np.split(ids, stops[:-1])

    def encode_all(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known = Remembered(self.ids_of, dict(self.known))
        out: list[np.ndarray] = []
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= TOGETHER:
                out += self.encode_some(some)
                some, size = [], 0
        return out + (self.encode_some(some) if some else [])
