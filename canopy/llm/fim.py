"""Fill-in-middle transformation with a sparse exception index (op 13).

A text is cut into prefix, middle and suffix at two units (lines, characters or bytes), and written
as `<P>`prefix`<S>`suffix`<M>`middle (psm) or `<S>`suffix`<P>`prefix`<M>`middle (spm). Which cuts,
and which form, follows from a sha256 of seed and doc_id alone: it is the same on every run.

Texts stay UTF-8 bytes. Cuts at lines are found as byte offsets, cuts at characters as code points,
and each needs the other. The index that converts them records only the multibyte characters: their
positions and how many bytes they exceed one by. A binary search among these counts the exceptions
before a cut; the spans of ASCII between them are plain arithmetic, and a text of ASCII has no index.

A text is left as it is (form plain) if it is empty, holds a marker, or falls outside `rate` percent.
Since no text with a marker is transformed, the first marker of each kind in an output is the
operator's own, and `restored` rebuilds the exact text from output and form.

Null texts are empty. A null doc_id hashes as the empty string. Repeated rows give repeated rows,
each text is worked on whole, and empty tables give no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, raw_text

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_P, _S, _M = (m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
SEED, RATE, SPM = 7, 100, 50
UNITS = ("line", "char", "byte")
SCHEMA = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
          "prefix_bytes long, middle_bytes long, output binary")


class Exceptions:
    """Converts cuts of a UTF-8 text between bytes and code points."""

    def __init__(self, text: bytes):
        self.bytes = self.chars = np.zeros(0, np.int64)
        self.excess = np.zeros(1, np.int64)
        if not text.isascii():
            raw = np.frombuffer(text, np.uint8)
            at = np.flatnonzero(raw >= 0xC0)
            first = raw[at]
            self.excess = np.concatenate([[0], np.cumsum(1 + (first >= 0xE0) + (first >= 0xF0))])
            self.bytes, self.chars = at, at - self.excess[:-1]

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte cut (a cut at the start of a character)."""
        return cuts - self.excess[np.searchsorted(self.bytes, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each code-point cut."""
        return cuts + self.excess[np.searchsorted(self.chars, cuts)]


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2^32 for a document."""
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(hexed[i:i + 8], 16) for i in range(0, 32, 8)]


def cuts(text: bytes, unit: str, h1: int, h2: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of units, and the two cuts in bytes and in code points."""
    index = Exceptions(text)
    if unit == "line":
        ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
        if not text.endswith(b"\n"):
            ends = np.append(ends, len(text))
        n = len(ends)
        starts = np.concatenate([[0], ends])
        at = starts[sorted((h1 % (n + 1), h2 % (n + 1)))]
        return n, at, index.to_chars(at)
    if unit == "char":
        n = len(text) - int(index.excess[-1])
        at = np.array(sorted((h1 % (n + 1), h2 % (n + 1))))
        return n, index.to_bytes(at), at
    n = len(text)
    # a byte inside a character moves back to the character's start
    raw, at = np.frombuffer(text, np.uint8), sorted((h1 % (n + 1), h2 % (n + 1)))
    for i in (0, 1):
        while at[i] < n and raw[at[i]] & 0xC0 == 0x80:
            at[i] -= 1
    return n, np.array(at), index.to_chars(np.array(at))


def transformed(doc_id: int | None, text: bytes | None, unit: str = "line", seed: int = SEED, rate: int = RATE,
                spm: int = SPM) -> tuple:
    """The row of SCHEMA for one document."""
    text = text or b""
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text:
        return doc_id, 0, "plain", None, None, None, None, b""
    n, at, chars = cuts(text, unit, h1, h2)
    if _P in text or _S in text or _M in text or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, None, None, text
    a, b = int(at[0]), int(at[1])
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    form = "spm" if h4 % 100 < spm else "psm"
    first = (_S, suffix, _P, prefix) if form == "spm" else (_P, prefix, _S, suffix)
    return doc_id, n, form, int(chars[0]), int(chars[1] - chars[0]), a, b - a, b"".join((*first, _M, middle))


def transform(docs: DataFrame, unit: str = "line", seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, n (units), form, lengths of prefix and middle in code points and bytes, output text."""
    if unit not in UNITS:
        raise ValueError(f"unit: one of {UNITS}")

    def rows(items: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in items:
            yield transformed(doc_id, text, unit, seed, rate, spm)

    made = map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text().alias("_text")), rows, SCHEMA)
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    p, s, m = (F.instr(output, marker) for marker in (PREFIX, SUFFIX, MIDDLE))
    width = len(PREFIX)

    def between(start: Column, end: Column) -> Column:
        return F.substring(output, start + width, end - start - width)

    middle = F.substring(output, m + width, F.length(output))
    return (F.when(form == "psm", F.concat(between(p, s), middle, between(s, m)))
            .when(form == "spm", F.concat(between(p, m), middle, between(s, p))).otherwise(output))


def digest(made: DataFrame) -> DataFrame:
    """Hashes of output and restored text in place of the texts."""
    text = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output"), 256).alias("output_sha256"),
                       F.sha2(text, 256).alias("restored_sha256"))
