"""Byte-level BPE ids of many texts at once.

A text is cut into pieces by the tokenizer's own split rule, evaluated on arrays of code points; a
piece's ids depend on the piece alone, so the library encodes each distinct piece once and the ids
of the texts are gathered from that store.
"""

from __future__ import annotations

import functools
import os
import unicodedata

import numpy as np
import pandas as pd

#: Code points handled at once, and distinct pieces remembered by a worker (some 60 MB); neither changes a result.
CHUNK = 1 << 20
STORE = 1_500_000

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
#: The code points with the White_Space property (fixed values).
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.cache
def _classes() -> np.ndarray:
    kind = {"L": _LETTER, "N": _NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[_WHITE] = _SPACE
    return out


@functools.cache
def _alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others for code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.cache
def _hashing() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random word per code point, and the powers of an odd base and of its inverse modulo 2^64."""
    rng = np.random.default_rng(0x5EED)
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    words = rng.integers(0, 1 << 64, 0x110000, dtype=np.uint64)

    def powers(b):
        return np.concatenate([np.ones(1, np.uint64), np.full(CHUNK, b, np.uint64)]).cumprod(dtype=np.uint64)
    return words, powers(base), powers(inverse)


def piece_starts(cp: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True where a piece starts.  ``cp``: code points of texts laid end to end; ``doc``: True at
    each text's first code point.

    Letters, numbers and other marks form pieces with one space before them; of a white-space run
    before a word only the last character is left, alone unless it is that space; the endings
    's 't 're 've 'm 'll 'd are pieces when the apostrophe stands alone and follows no space.
    """
    n = len(cp)
    cls = _classes()[cp]
    new = doc.copy()
    new[1:] |= cls[1:] != cls[:-1]
    inside = np.append(~doc[1:], False)                  # the next code point belongs to the same text
    follows = np.append(False, inside[:-1])              # the one before does
    space = cls == _SPACE
    after_blank = follows & np.append(False, cp[:-1] == 0x20)
    start = new & (space | ~after_blank)
    start[:-1] |= space[:-1] & inside[:-1] & ~space[1:]  # last white-space character before a word
    quote = np.flatnonzero((cp == 0x27) & new & ~after_blank & inside)
    if len(quote):
        ends = np.append(cp, np.zeros(2, cp.dtype))
        own = np.append(doc, np.ones(2, bool))
        a, b = ends[quote + 1], ends[quote + 2]
        two = np.isin(a, [ord(c) for c in "stmd"])
        three = ~own[quote + 2] & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e")))
                                   | ((a == ord("l")) & (b == ord("l"))))
        size = np.where(two, 2, np.where(three, 3, 0))
        hit = size > 0
        start[quote[hit] + 1] = False
        past = quote[hit] + size[hit]
        past = past[past < n]
        past = past[~space[past]]                        # white space starts by its own rule
        start[past] = True
    return start


class PieceEncoder:
    """Encodes texts with a byte-level BPE of the tokenizers library, without added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spelled = {b: ord(c) for b, c in _alphabet().items()}
        self._clear()

    def _clear(self):
        self.codes = np.zeros(0, np.uint64)              # known pieces, ascending, and their places
        self.places = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.at = np.zeros(0, np.int64)
        self.met = np.zeros(0, np.uint8)                 # chunks that had the piece, two at most
        self.ids = np.zeros(4096, np.uint32)
        self.used = 0

    def _evict(self):
        """Forget the pieces met in one chunk only; everything, if that leaves too many."""
        keep = np.flatnonzero(self.met > 1)
        if len(keep) > STORE // 2:
            return self._clear()
        new = np.full(len(self.met), -1)
        new[keep] = np.arange(len(keep))
        size = self.size[keep]
        total = np.cumsum(size)
        flat = np.arange(int(total[-1]) if len(keep) else 0) + np.repeat(self.at[keep] - (total - size), size)
        kept = self.met[self.places] > 1
        self.codes, self.places = self.codes[kept], new[self.places[kept]]
        self.ids, self.used = self.ids[flat], len(flat)
        self.size, self.at, self.met = size, total - size, np.ones(len(keep), np.uint8)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids per text, as the library gives them for the whole text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        group, size = [], 0
        for i, t in enumerate(texts):
            if any(m in t for m in self.marks) or len(t) > CHUNK:  # added tokens are cut out first
                out[i] = self._whole(t)
                continue
            if size + len(t) > CHUNK:
                self._chunk(texts, group, out)
                group, size = [], 0
            group.append(i)
            size += len(t)
        self._chunk(texts, group, out)
        return out

    def _chunk(self, texts, group, out):
        joined = "".join([texts[i] for i in group])
        if not joined:
            for i in group:
                out[i] = np.zeros(0, np.uint32)
            return
        cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(texts[i]) for i in group])
        doc = np.zeros(len(cp) + 1, bool)
        doc[0] = True
        doc[ends] = True
        start = np.flatnonzero(piece_starts(cp, doc[:-1]))
        stop = np.append(start[1:], len(cp))
        words, power, inverse = _hashing()
        sums = np.append(np.zeros(1, np.uint64), np.cumsum(words[cp] * power[:len(cp)], dtype=np.uint64))
        code = (sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64)
        which, distinct = pd.factorize(code)
        first = np.empty(len(distinct), np.int64)
        first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        place = self._place(joined, distinct, start[first], stop[first])[which]
        size = self.size[place]
        total = np.cumsum(size)
        flat = np.arange(int(total[-1])) + np.repeat(self.at[place] - (total - size), size)
        ids = self.ids[flat]
        # ids before each text's end: those of the pieces that start before it
        upto = np.append(0, total)[np.searchsorted(start, ends)]
        lo = 0
        for i, hi in zip(group, upto.tolist()):
            out[i] = ids[lo:hi]
            lo = hi

    def _place(self, joined, code, start, stop) -> np.ndarray:
        if len(self.codes) > STORE:
            self._evict()
        order = np.argsort(code)
        code = code[order]
        at = np.searchsorted(self.codes, code)
        hit = at < len(self.codes)
        hit[hit] = self.codes[at[hit]] == code[hit]
        got = np.empty(len(code), np.int64)
        got[hit] = self.places[at[hit]]
        self.met[got[hit]] = 2
        new = np.flatnonzero(~hit)
        if len(new):
            # the library's merge model on one piece, its bytes spelled in the vocabulary's alphabet
            merge, spelled = self.tokenizer.model.tokenize, self.spelled
            ids = [[t.id for t in merge(joined[a:b].encode().decode("latin-1").translate(spelled))]
                   for a, b in zip(start[order[new]].tolist(), stop[order[new]].tolist())]
            size = np.array([len(x) for x in ids], np.int64)
            flat = np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum()))
            n = len(self.size)
            got[new] = np.arange(n, n + len(new))
            self.size = np.append(self.size, size)
            self.at = np.append(self.at, self.used + np.cumsum(size) - size)
            self.met = np.append(self.met, np.ones(len(new), np.uint8))
            while len(self.ids) < self.used + len(flat):
                self.ids = np.append(self.ids, np.zeros(len(self.ids), np.uint32))
            self.ids[self.used:self.used + len(flat)] = flat
            self.used += len(flat)
            self.codes, self.places = np.insert(self.codes, at[new], code[new]), np.insert(self.places, at[new], got[new])
        out = np.empty(len(code), np.int64)
        out[order] = got
        return out


@functools.cache
def encoder(path: str) -> PieceEncoder:
    """One encoder per worker and file."""
    return PieceEncoder(path)
