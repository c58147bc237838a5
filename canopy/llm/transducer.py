"""SentencePiece encoding and decoding by weighted finite-state transducer (op 4).

A model file is compiled once per worker into three machines:

- the normaliser, a transducer that writes the space symbol for a space (and one before the text);
- the pieces, a prefix tree whose accepting nodes write a piece, with byte fallback as arcs that
  write the bytes of a character that is no piece;
- the weights. A unigram model has one state and costs a piece its negative score. A BPE model has
  a state per piece and costs nothing where the merges of the two pieces' joined text give these two
  pieces back, and infinity elsewhere: a sequence whose neighbours all pass is the one that merging
  the whole text gives, so the least-cost path is the model's own segmentation.

Encoding composes them with the text lazily: lattice states are (position, weight state), and the
shortest path in the tropical semiring (min, +) is found position by position. Decoding is the
inverse transduction. No piece has the space symbol behind another character, so the lattice falls
apart at spaces and wherever no piece holds two neighbouring characters; the paths of such chunks
are kept in a bounded cache.

Runs of spaces have pieces of equal score, which merge from the left; their paths are written
directly. Models with a character map other than identity are refused. A space symbol in a text is
read as a space, as the library does. Null and empty texts have no ids. Repeated rows give equal
rows, an empty table none. Only doc_id and text are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .common import append

USES = ("transducer",)
SPACE = "▁"
# Fixed values of the public model format: field numbers and piece types.
PIECES, TRAINER, NORMALIZER, MODEL_TYPE = 1, 2, 3, 3
TEXT, SCORE, TYPE = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CHARSMAP, DUMMY_PREFIX, EXTRA_SPACES = 2, 3, 4
UNIGRAM, BPE = 1, 2
#: Chunks (and pairs of pieces) in a worker's caches; beyond, they start anew. They only save time.
CACHE_CHUNKS = 300_000
START = -1  # the weight state before the first piece, and behind a character written as bytes
_MODELS: dict[str, Transducer] = {}


def fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol-buffer message."""
    i = 0

    def varint() -> int:
        nonlocal i
        x = shift = 0
        while True:
            c = b[i]
            i += 1
            x |= (c & 127) << shift
            shift += 7
            if c < 128:
                return x

    while i < len(b):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        n = varint() if kind == 2 else 8 if kind == 1 else 4
        yield tag >> 3, b[i:i + n]
        i += n


class Transducer:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            top = list(fields(f.read()))
        trainer = dict(fields(next((v for k, v in top if k == TRAINER), b"")))
        normal = dict(fields(next((v for k, v in top if k == NORMALIZER), b"")))
        if normal.get(CHARSMAP):
            raise ValueError(f"{path}: only the identity normaliser is compiled")
        self.kind = trainer.get(MODEL_TYPE, UNIGRAM)
        self.dummy, self.squeeze = normal.get(DUMMY_PREFIX, 1), normal.get(EXTRA_SPACES, 1)
        self.text: list[str] = []
        self.score: list[float] = []
        self.byte = {}
        self.id: dict[str, int] = {}
        self.tree: dict = {}
        self.unknown = 0
        for i, raw in enumerate(v for k, v in top if k == PIECES):
            p = dict(fields(raw))
            s, kind = p[TEXT].decode(), p.get(TYPE, NORMAL)
            self.text.append(s)
            self.score.append(struct.unpack("<f", p.get(SCORE, b"\0\0\0\0"))[0])
            if kind == BYTE:
                self.byte[int(s[3:5], 16)] = i
            elif kind == UNKNOWN:
                self.unknown = i
            elif kind in (NORMAL, USER):
                self.id[s] = i
                if self.kind != BPE or set(s) != {SPACE} or len(s) == 1:
                    node = self.tree
                    for c in s:
                        node = node.setdefault(c, {})
                    node[""] = i
        of_id = {i: b for b, i in self.byte.items()}
        self.is_byte = np.array([i in of_id for i in range(len(self.text))])
        #: what each id stands for in a decoded text
        self.shown = [bytes([of_id[i]]) if i in of_id else " ⁇ ".encode() if i == self.unknown
                      else x.replace(SPACE, " ").encode() for i, x in enumerate(self.text)]
        runs = {self.score[i] for s, i in self.id.items() if set(s) == {SPACE} and len(s) > 1}
        if self.kind == BPE and len(runs) > 1:
            raise ValueError(f"{path}: runs of spaces have different scores")
        if any(SPACE in s.lstrip(SPACE) for s in self.id):
            raise ValueError(f"{path}: a piece has a space inside")
        self.joins = {x[i:i + 2] for x in self.id for i in range(len(x) - 1)}
        self.penalty = 10.0 - min(self.score)
        self.pairs: dict[int, bool] = {}
        #: two generations: what is met again moves from the old one to the new one
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    # weights

    def merge(self, s: str) -> list[str]:
        """Best-first merging of a short string, the definition of a BPE model's segmentation."""
        parts = list(s)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                t = self.id.get(parts[i] + parts[i + 1])
                if t is not None and (best is None or self.score[t] > best):
                    best, at = self.score[t], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def legal(self, state: int, piece: int) -> bool:
        """Whether a BPE model leaves two pieces as they are when their joined text is merged."""
        if len(self.pairs) > 4 * CACHE_CHUNKS:
            self.pairs.clear()
        before = [self.text[state]] if state >= 0 else []
        ok = self.merge("".join(before) + self.text[piece]) == [*before, self.text[piece]]
        self.pairs[state * len(self.text) + piece] = ok
        return ok

    # composition and shortest path

    def path(self, s: str) -> list[int]:
        """The ids of the least-cost path through the lattice of a chunk."""
        return self.legal_path(s) if self.kind == BPE else self.cheapest_path(s)

    def arcs(self, s: str, i: int) -> list[tuple[int, int]]:
        """(end, piece) of the pieces that start at i, shortest first; -1 stands for a character's bytes."""
        out, node = [], self.tree
        for j in range(i, len(s)):
            node = node.get(s[j])
            if node is None:
                break
            piece = node.get("")
            if piece is not None:
                out.append((j + 1, piece))
        if not out or out[0][0] > i + 1:
            out.insert(0, (i + 1, -1))
        return out

    def legal_path(self, s: str) -> list[int]:
        """BPE: finite paths cost 0 and only one reaches the end, so the lattice is searched in
        depth, longest arcs first, and no (position, last piece) that failed is entered again."""
        n, pairs, size = len(s), self.pairs, len(self.text)
        trail, failed = [(0, START, self.arcs(s, 0))], set()
        while trail[-1][0] < n:
            i, at, open_ = trail[-1]
            while open_:
                j, piece = open_.pop()
                if (j, piece) in failed:
                    continue
                at_key = START if at < 0 else at
                ok = piece < 0 or pairs.get(at_key * size + piece)
                if ok or ok is None and self.legal(at_key, piece):
                    trail.append((j, piece, self.arcs(s, j) if j < n else []))
                    break
            else:
                failed.add((i, at))
                trail.pop()
        return self.written(s, [(j, piece) for j, piece, _ in trail[1:]])

    def cheapest_path(self, s: str) -> list[int]:
        """Unigram: one weight state, so the least cost to each position, in order."""
        n = len(s)
        cost: list[float | None] = [0.0] + [None] * n
        back: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        for i in range(n):
            if cost[i] is None:
                continue
            for j, piece in self.arcs(s, i):
                c = cost[i] + (self.penalty if piece < 0 else -self.score[piece])
                if cost[j] is None or c < cost[j]:
                    cost[j], back[j] = c, (i, piece)
        found, i = [], n
        while i:
            found.append((i, back[i][1]))
            i = back[i][0]
        return self.written(s, found[::-1])

    def written(self, s: str, path: list[tuple[int, int]]) -> list[int]:
        """The ids that a path of (end, piece) writes."""
        out = []
        for j, piece in path:
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.byte[b] for b in s[j - 1].encode()] if self.byte else [self.unknown]
        return out

    def spaces(self, n: int) -> list[int]:
        """A run of space symbols: its pieces have equal scores, so the leftmost pair merges first."""
        out: list[int] = []
        for _ in range(n):
            out.append(1)
            while len(out) > 1 and SPACE * (out[-2] + out[-1]) in self.id:
                out[-2:] = [out[-2] + out[-1]]
        return [self.id[SPACE * k] for k in out]

    def chunk(self, s: str) -> bytes:
        """The ids of a chunk (spaces, then other characters), as little-endian bytes."""
        found = self.cache.get(s)
        if found is None:
            if len(self.cache) > CACHE_CHUNKS:
                self.old, self.cache = self.cache, {}
            if s in self.old:
                found = self.cache[s] = self.old[s]
                return found
            rest = s.lstrip(SPACE)
            k = len(s) - len(rest)
            if k > 1 and self.kind == BPE:
                ids = np.frombuffer(self.chunk(SPACE + rest), "<u4").tolist()
                own = ids[0] == self.id.get(SPACE)
                found = _le(self.spaces(k if own else k - 1) + ids[1 if own else 0:])
            else:
                # no piece holds these two characters side by side: the lattice falls apart here
                cuts = None if rest.isalpha() else [i for i in range(1, len(s)) if s[i - 1:i + 1] not in self.joins]
                if cuts:
                    found = b"".join(map(self.chunk, (s[i:j] for i, j in zip([0, *cuts], [*cuts, len(s)], strict=True))))
                else:
                    found = _le(self.path(s))
            self.cache[s] = found
        return found

    def normalise(self, text: str) -> str:
        s = text.replace(SPACE, " ")
        if self.squeeze:
            s = " ".join(x for x in s.split(" ") if x)
        return (SPACE if self.dummy and s else "") + s.replace(" ", SPACE)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit bytes."""
        s = self.normalise(text)
        head, *words = s.split(SPACE)
        # an empty word is part of a run of spaces that belongs to the next chunk
        out = [self.chunk(head)] if head else []
        run = 1
        cache, last = self.cache, len(words) - 1
        for k, w in enumerate(words):
            if not w and k < last:
                run += 1
                continue
            c = SPACE * run + w
            found = cache.get(c)
            if found is None:
                found = self.chunk(c)
                cache = self.cache
            out.append(found)
            run = 1
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text that a sequence of ids stands for."""
        out = b"".join(map(self.shown.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        s = out.decode("utf-8", "replace")
        return s[1:] if self.dummy and s[:1] == " " else s


def _le(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def drop_caches() -> None:
    for t in _MODELS.values():
        t.cache, t.old = {}, {}
        t.pairs.clear()


def transducer(path: str) -> Transducer:
    if path not in _MODELS:
        _MODELS[path] = Transducer(path)
    return _MODELS[path]


def encode(docs: DataFrame, model: str, keep: list[str]) -> DataFrame:
    """The columns `keep` and `ids`, the text's ids as little-endian unsigned 32-bit bytes."""
    return append(docs, "text", lambda texts: [(transducer(model).encode((t or b"").decode("utf-8", "replace")),) for t in texts],
                  "ids binary", keep, USES)


def decode(ids: DataFrame, model: str, keep: list[str]) -> DataFrame:
    """The columns `keep` and `decoded`, the text of `ids`."""
    return append(ids, "ids", lambda rows: [(transducer(model).decode(r or b""),) for r in rows], "decoded string", keep, USES)


def digest(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, n_byte_tokens, ids_crc32, round_trip (decoding gives the text again)."""

    def made(texts: list[bytes | None]) -> list[tuple]:
        t, out = transducer(model), []
        for raw in texts:
            s = (raw or b"").decode("utf-8", "replace")
            ids = t.encode(s)
            n = np.frombuffer(ids, "<u4")
            out.append((len(n), int(t.is_byte[n].sum()), zlib.crc32(ids), t.decode(ids) == s))
        return out

    return append(docs, "text", made, "n_tokens long, n_byte_tokens long, ids_crc32 long, round_trip boolean", ["doc_id"], USES)
