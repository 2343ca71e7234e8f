"""Token ids of whole texts by the tokenizers library, one library call per distinct pre-token.

A byte-level BPE model merges inside pre-tokens only, so a text's ids are the ids of its pre-tokens in order.  Texts
made only of characters of ``SAFE`` are cut here, a part of about ``PART_CHARS`` characters at a time and with array
operations only: each pre-token is known by a 64-bit hash of its characters, each distinct one goes through the library
once per worker and step (its ids are kept in a bounded store), and a part's ids are gathered with one look-up.  Any other text,
and any that may hold a special token, goes through the library whole.  Both ways give the library's ids.  Two
pre-tokens of one store share a hash with a probability of about 2 ** -25 for a full store.

A text longer than a part is cut at single spaces between words, where a pre-token begins whatever stands before; so a
very long text needs no more memory than its own ids.
"""

from __future__ import annotations

import os
import re

import numpy as np

from martlake.llm.common import keep

#: Letters whose class, case and normal form no Unicode version or library treats differently.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ňŊ-ž"
SAFE = re.compile(f"[\\t\\n\\r\\x20-\\x7e{LETTERS}¡-§©«®°±¶·»¿"
                  "×÷–—‘’“”…€]*")
#: The published split pattern of the word vocabulary, with the classes restricted to SAFE texts.
WORD_LEVEL = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\s0-9{LETTERS}]+")
#: Pre-tokens a worker remembers (about 35 bytes each); then it starts anew.
CACHE_ENTRIES = 1_000_000
JOINED = 200
PART_CHARS = 1_000_000
#: Longer pre-tokens send their text through the library whole.
LONGEST = 1024

def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


WHITE, LETTER, DIGIT, OTHER, UNSAFE = range(5)
_CHARS = 0x2100  # SAFE ends below
_APOSTROPHE, _SPACE = ord("'"), ord(" ")
#: What is cut off behind an apostrophe: one letter, or two.
_ONE, _TWO = np.array([ord(c) for c in "stmd"]), {(ord(a), ord(b)) for a, b in ("re", "ve", "ll")}


def _classes() -> np.ndarray:
    out = np.full(_CHARS + 1, UNSAFE, np.uint8)
    letter = re.compile(f"[{LETTERS}]")
    for k in range(_CHARS):
        c = chr(k)
        if SAFE.fullmatch(c):
            out[k] = WHITE if c in "\t\n\r " else DIGIT if c in "0123456789" else LETTER if letter.match(c) else OTHER
    return out


_CLASS = _classes()
_rng = np.random.default_rng(8)
_OF_CHAR = _rng.integers(0, 1 << 64, _CHARS + 1, np.uint64)
_OF_PLACE = _rng.integers(0, 1 << 63, LONGEST, np.uint64) * np.uint64(2) + np.uint64(1)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts, one behind the other, and where each text ends."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return np.minimum(codes, _CHARS), np.cumsum([len(t) for t in texts])


def pre_token_starts(codes: np.ndarray, kind: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of SAFE texts begin: runs of letters, digits or others, each with one space before it;
    white space but for its last character if a word follows; and the ends of contractions behind an apostrophe."""
    n = len(codes)
    fresh = np.zeros(n + 1, bool)  # a text begins here (or ended before)
    fresh[0], fresh[ends] = True, True
    run = fresh[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    at = np.flatnonzero(run)
    end, what = np.append(at[1:], n), kind[at]
    start = np.zeros(n, bool)
    white = what == WHITE
    start[at[white]] = True
    start[end[white & ~fresh[end] & (end - at > 1)] - 1] = True
    spaced = ~fresh[at] & (codes[at - 1] == _SPACE) & ~white
    start[at[~white & ~spaced]] = True

    k = np.flatnonzero((what == OTHER) & (end - at == 1) & (codes[at] == _APOSTROPHE) & ~spaced & ~fresh[end])
    k = k[what[np.minimum(k + 1, len(at) - 1)] == LETTER] + 1  # the letters behind
    size, first = end[k] - at[k], codes[at[k]]
    second = codes[np.minimum(at[k] + 1, n - 1)]
    one = np.isin(first, _ONE)
    two = np.zeros(len(k), bool)
    for a, b in _TWO:
        two |= (first == a) & (second == b) & (size > 1)
    start[at[k[one | two]]] = False
    start[at[k[one & (size > 1)]] + 1] = True
    start[at[k[two & (size > 2)]] + 2] = True
    return np.flatnonzero(start)


class Encoder:
    """ids(texts) -> one bytes object per text, little-endian ids of ``dtype``."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.dtype = id_type(self.tokenizer)
        self.end = np.zeros(1, self.dtype).tobytes()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        newline = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.newline = newline[0] if len(newline) == 1 else None
        self.forget()

    def forget(self) -> None:
        """The store: sorted hashes of pre-tokens, and where the ids of each lie."""
        self.hashes, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def library(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens, one behind the other, and how many each has.  They go many to a text, a line each: a
        line break is a pre-token of its own, and its id stands nowhere else."""
        parts = [pieces[k:k + JOINED] for k in range(0, len(pieces), JOINED)]
        encoded = self.tokenizer.encode_batch_fast(["\n".join(x) for x in parts], add_special_tokens=False)
        ids = np.concatenate([np.array([*enc.ids, self.newline], self.dtype) for enc in encoded])
        breaks = np.flatnonzero(ids == self.newline)
        return np.delete(ids, breaks), np.diff(breaks, prepend=-1) - 1

    def learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        if len(self.hashes) + len(hashes) > CACHE_ENTRIES:
            self.forget()
        alone = np.array([self.newline is None or p.isspace() for p in pieces], bool)
        by_one = [enc.ids for enc in self.tokenizer.encode_batch_fast([p for p, a in zip(pieces, alone) if a],
                                                                      add_special_tokens=False)]
        found, size = np.array([k for x in by_one for k in x], self.dtype), np.array([len(x) for x in by_one], np.int64)
        if not alone.all():
            more, sizes = self.library([p for p, a in zip(pieces, alone) if not a])
            found, size = np.concatenate([found, more]), np.concatenate([size, sizes])
        at = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, found])
        hashes, at, size = (np.concatenate(x) for x in (
            (self.hashes, hashes[alone], hashes[~alone]), (self.at, at), (self.size, size)))
        by = np.argsort(hashes, kind="stable")
        self.hashes, self.at, self.size = hashes[by], at[by], size[by]

    def ids(self, texts: list[str]) -> list[bytes]:
        """In parts, so that only a part's pre-tokens are in memory at a time."""
        out: list[list[bytes]] = [[] for _ in texts]
        part, of, chars = [], [], 0

        def done() -> None:
            for k, ids in zip(of, self._ids(part)):
                out[k].append(ids)

        for k, text in enumerate(texts):
            pieces = [text] if len(text) <= PART_CHARS or any(x in text for x in self.specials) or not SAFE.fullmatch(text) \
                else pieces_of(text)
            for piece in pieces:
                part.append(piece)
                of.append(k)
                chars += len(piece)
                if chars >= PART_CHARS:
                    done()
                    part, of, chars = [], [], 0
        done()
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _ids(self, texts: list[str]) -> list[bytes]:
        codes, ends = code_points(texts)
        if not len(codes):
            return [b""] * len(texts)
        kind = _CLASS[codes]
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(ends, np.flatnonzero(kind == UNSAFE), "right")] = True
        for k, text in enumerate(texts):
            odd[k] |= any(x in text for x in self.specials)
        if odd.any():
            own = iter(self._ids([t for t, o in zip(texts, odd) if not o]))
            return [self.whole(t) if o else next(own) for t, o in zip(texts, odd)]

        starts = pre_token_starts(codes, kind, ends)
        size = np.diff(starts, append=len(codes))
        if size.max() > LONGEST:
            odd[np.searchsorted(ends, starts[size > LONGEST], "right")] = True
            own = iter(self._ids([t for t, o in zip(texts, odd) if not o]))
            return [self.whole(t) if o else next(own) for t, o in zip(texts, odd)]
        place = np.arange(len(codes)) - np.repeat(starts, size)
        hashes = np.add.reduceat(_OF_CHAR[codes] * _OF_PLACE[place], starts)
        known, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = self.missing(known)
        if len(new):
            if len(self.hashes) + len(new) > CACHE_ENTRIES:
                new = np.arange(len(known))  # the store starts anew, with all of this part
            joined = "".join(texts)
            self.learn(known[new], [joined[starts[k]:starts[k] + size[k]] for k in first[new]])
        slot = np.searchsorted(self.hashes, known)
        n = self.size[slot][which]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.arange(total[-1]) + np.repeat(self.at[slot][which] - total[:-1], n)]
        cut = total[np.searchsorted(starts, np.concatenate([[0], ends]))].tolist()
        return [ids[a:z].tobytes() for a, z in zip(cut[:-1], cut[1:])]

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.arange(len(hashes))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.flatnonzero(self.hashes[at] != hashes)


def pieces_of(text: str) -> list[str]:
    """A long text cut before single spaces between words, so that each piece is about a part."""
    single, cuts = re.compile(r"(?<=\S) (?=\S)"), [0]
    while (m := single.search(text, cuts[-1] + PART_CHARS)) is not None:
        cuts.append(m.start())
    return [text[a:z] for a, z in zip(cuts, [*cuts[1:], len(text)])]


def id_type(tokenizer) -> np.dtype:
    return np.dtype("<u4" if tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16 else "<u2")


def encoder(path: str) -> Encoder:
    """One encoder a worker and step: its store serves the step's tasks, and the worker's next step drops it."""
    return keep(f"encoder {path}", lambda: Encoder(path))


def id_width(path: str) -> np.dtype:
    """The type of the ids of a vocabulary."""
    return id_type(load(path))
