"""Token ids of a `tokenizers` file with white-space-free tokens, with a bounded cache of words.

The vocabulary drops white space and no token crosses it, so a text's ids are the ids of its
white-space-separated chunks, joined. Chunks repeat, so each worker keeps the ids of the chunks
it has met (as little-endian unsigned 32-bit bytes) and sends only new ones to the library.
"""

from __future__ import annotations

import json
import os

import numpy as np

#: Chunks in one generation of a worker's cache (about 60 MB); the cache only saves time.
CACHE_CHUNKS = 500_000
_CODERS: dict[str, Coder] = {}


class Coder:
    """ids(texts) gives the ids of each text as bytes."""

    def __init__(self, path: str):
        self.chunks = CACHE_CHUNKS
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        kinds = [n["type"] for n in json.loads(self.full.to_str())["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: the chunk cache needs a lower-casing vocabulary without white space")
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # the byte-level letters of the Latin-1 range and its neighbours, read from the library
        self.shown = {i: byte_level.pre_tokenize_str(chr(i))[0][0] for i in range(0x80, 0x130)}
        self.ends = {"": b""} | {x: _le(self.full.encode(x, add_special_tokens=False).ids) for x in ".,"}
        #: two generations: what is met again moves from the old one to the new one
        self.cache: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, texts: list[bytes | None]) -> list[bytes]:
        split = [_lower(t).split() if t else [] for t in texts]
        if len(self.cache) > self.chunks:
            self.old, self.cache = self.cache, {}
        chunks = set().union(*split)
        self._learn([w for w in chunks if w not in self.cache])
        get = self.cache.__getitem__
        return [b"".join(map(get, ws)) for ws in split]

    def _learn(self, chunks: list[bytes]) -> None:
        """Cache the ids of new chunks.

        A chunk of letters below U+0130 is one pre-token: lower-casing is per letter there, so the
        words-only tokenizer takes many at once. A full stop or comma behind a letter is a token of
        its own. Everything else goes to the whole tokenizer.
        """
        cache, old = self.cache, self.old
        parts: list[tuple[bytes, bytes, str]] = []
        letters: set[bytes] = set()
        other: list[tuple[bytes, str]] = []
        for w in chunks:
            if w in old:
                cache[w] = old[w]
            elif w.isalpha() and w.islower():
                letters.add(w)
            else:
                tail = chr(w[-1]) if w[-1] in b".," and len(w) > 1 else ""
                core = w[:-1] if tail else w
                if not (core.isalpha() and core.islower()):
                    s = core.decode("utf-8", "replace")
                    if not s.isalpha() or max(s) >= "İ":
                        other.append((w, w.decode("utf-8", "replace")))
                        continue
                    core = s.lower().encode()
                if core in old:
                    cache[core] = old[core]
                elif core not in cache:
                    letters.add(core)
                if core != w:
                    parts.append((w, core, tail))
        self._letters([w for w in letters if w.isascii()])
        self._letters([w for w in letters if not w.isascii()])
        for w, b, tail in parts:
            cache[w] = cache[b] + self.ends[tail]
        for i in range(0, len(other), 2000):
            some = other[i:i + 2000]
            for (w, _), e in zip(some, self.full.encode_batch_fast([s for _, s in some], add_special_tokens=False), strict=True):
                cache[w] = _le(e.ids)

    def _letters(self, words: list[bytes]) -> None:
        for i in range(0, len(words), 500):
            some = words[i:i + 500]
            line = b" ".join(some).decode()
            e = self.words.encode(line if line.isascii() else line.translate(self.shown), add_special_tokens=False)
            ids = _le(e.ids)
            ends = (4 * np.searchsorted(np.array(e.word_ids), np.arange(len(some)), side="right")).tolist()
            at = 0
            for w, to in zip(some, ends, strict=True):
                self.cache[w] = ids[at:to]
                at = to


def _lower(text: bytes) -> bytes:
    """A-Z lower-cased, as the vocabulary does anyway, unless that could write a special token."""
    low = text.lower()
    return text if b"<|" in low else low


def _le(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def drop_caches() -> None:
    for c in _CODERS.values():
        c.cache, c.old = {}, {}


def coder(path: str, chunks: int = CACHE_CHUNKS) -> Coder:
    """The worker's coder of a vocabulary file; `chunks` bounds a generation of its cache."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    _CODERS[path].chunks = chunks
    return _CODERS[path]
