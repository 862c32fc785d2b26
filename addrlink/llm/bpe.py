"""Ids of a public word-BPE vocabulary for many texts, word by word.

The vocabulary's pre-tokenizer never joins characters across white space, so the
ids of a text are the ids of its space-separated words in turn. Each distinct
word is encoded once per Python worker (a cache of bounded bytes, by the word
itself) and ids are dealt to texts with array operations. Words outside plain Latin letters, and whole texts
that hold the vocabulary's special strings, go through the library as they are.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa

from .tokens import Words

#: Words of these characters alone need no normalisation but lower case.
PLAIN = re.compile("[!-~À-įı-ſ]+")
#: Fixed value: the vocabulary file's pre-tokenizer pattern, for plain lower-case words.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")
CACHE_BYTES = 160_000_000  # several times what one slice of texts brings; of words, ids and pieces held, by their usual size in Python


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as a visible character: printable Latin-1 as itself, the rest from U+0100 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {b: chr(b) for b in kept}, 256
    for b in range(256):
        if b not in out:
            out[b], extra = chr(extra), extra + 1
    return out


LETTERS = _byte_letters()


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.specials = [x.content for x in self.full.get_added_tokens_decoder().values()]
        self.pieces: dict[str, list[int]] = {}
        self.clear()

    def clear(self) -> None:
        self.at: dict[bytes, int] = {}  # word -> its number
        self.held = 0
        self.flat, self.used = np.empty(1 << 18, np.int32), 0
        self.bound, self.count = np.zeros(1 << 16, np.int64), 0
        self.pieces.clear()

    def encode(self, text: str) -> list[int]:
        return self.full.encode(text, add_special_tokens=False).ids

    def word(self, raw: bytes) -> list[int]:
        if raw.isalpha():  # plain letters are one piece
            return self.piece(raw.lower().decode("ascii"))
        text = raw.decode("utf-8")
        if not (raw.isascii() and text.isprintable() or PLAIN.fullmatch(text)):
            return self.encode(text)
        pieces = PIECES.findall(text.lower())
        if len(pieces) == 1:
            return self.piece(pieces[0])
        out: list[int] = []
        held = self.pieces
        for piece in pieces:
            out += held[piece] if piece in held else self.piece(piece)
        return out

    def piece(self, piece: str) -> list[int]:
        ids = self.pieces.get(piece)
        if ids is None:
            letters = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(LETTERS)  # ASCII letters of a plain word stand for themselves
            ids = self.pieces[piece] = [x.id for x in self.model.tokenize(letters)]
            self.held += 250 + 2 * len(piece) + 8 * len(ids)
        return ids

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a slice."""
        words = Words(texts)
        if self.held > CACHE_BYTES:
            self.clear()
        distinct, one, where = np.unique(words.hash, return_index=True, return_inverse=True)
        raw = words.data.tobytes()
        keys = [raw[a:b] for a, b in zip(words.start[one].tolist(), words.end[one].tolist(), strict=True)]
        number = np.fromiter(map(self.at.get, keys, repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(number < 0)
        fresh, new, size = [keys[k] for k in missing.tolist()], [], []
        for key in fresh:
            ids = self.word(key)
            new += ids
            size.append(len(ids))
        if fresh:
            used, count = self.used + len(new), self.count + len(fresh)
            if used > len(self.flat):
                self.flat = np.concatenate([self.flat[: self.used], np.empty(max(used, 2 * len(self.flat)) - self.used, np.int32)])
            if count >= len(self.bound):
                self.bound = np.concatenate([self.bound[: self.count + 1], np.zeros(max(count + 1, 2 * len(self.bound)) - self.count - 1, np.int64)])
            self.flat[self.used : used] = new
            self.bound[self.count + 1 : count + 1] = self.used + np.cumsum(size)
            number[missing] = np.arange(self.count, count)
            self.at.update(zip(fresh, range(self.count, count), strict=True))
            self.held += 150 * len(fresh) + sum(map(len, fresh)) + 4 * len(new)
            self.used, self.count = used, count
        bound = self.bound
        number = number[where] if len(where) else np.zeros(0, np.int64)
        start, size = bound[number], bound[number + 1] - bound[number]
        to = np.cumsum(size)
        ids = self.flat[np.repeat(start - (to - size), size) + np.arange(int(to[-1]) if len(to) else 0)]
        cut = np.r_[0, to][words.first]
        out = [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        for special in self.specials:
            if special.encode() in raw:
                for d in range(len(texts)):
                    if special in (whole := texts[d].as_py()):
                        out[d] = np.asarray(self.encode(whole), np.int32)
        return out


_held: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's own encoder for a vocabulary, kept between tasks."""
    if path not in _held:
        _held[path] = Encoder(path)
    return _held[path]
