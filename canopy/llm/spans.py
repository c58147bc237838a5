"""Spans of regular expressions as native columns, for the two scanners (op 3, op 8).

A span is a struct (kind, start, end, match): code points, end exclusive. Spark gives the matches
of a pattern and the pieces between them; positions are running sums of their lengths. Patterns
must not match the empty string. Patterns are Java's; possessive quantifiers keep them from
backtracking or recursing over long runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,end:int,match:string,group:string>"
NONE = f"array<{SPAN}>"


def none() -> Column:
    return F.array().cast(NONE)


def matches(text: str, regex: str, group: int = 0, only: Column | None = None) -> Column:
    """All matches of a pattern (or one group of them), or an empty array where `only` is false."""
    found = F.regexp_extract_all(F.col(text), F.lit(regex), F.lit(group))
    return found if only is None else F.when(only, found).otherwise(F.array().cast("array<string>"))


def gaps(text: str, regex: str, found: str) -> Column:
    """The text before each match in `found`."""
    n = F.size(found)
    return F.when(n > 0, F.slice(F.split(F.col(text), regex, -1), F.lit(1), n)).otherwise(F.array().cast("array<string>"))


def place(kind: str, found: str, between: str, group: str | None = None) -> Column:
    """The spans of the matches in `found` with the texts `between` before them."""
    group_col = F.col(group) if group else F.transform(F.col(found), lambda x: F.lit(None).cast("string"))
    start = F.struct(F.lit(0).alias("at"), none().alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["m"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["m"].alias("match"), x["g"].alias("group"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    rows = F.arrays_zip(F.col(between).alias("gap"), F.col(found).alias("m"), group_col.alias("g"))
    return F.when(F.size(found) > 0, F.aggregate(rows, start, step, lambda a: a["out"])).otherwise(none())


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Luhn's checksum of a string of digits."""
    n = F.length(d)

    def term(i: Column) -> Column:
        v = F.ascii(F.substr(d, n - i + 1, F.lit(1))) - 48
        twice = 2 * v
        return F.when(i % 2 == 1, v).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + term(i))
    return (n > 0) & (total % 10 == 0)


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def merged(arrays: list[str]) -> Column:
    return F.concat(*(F.col(a) for a in arrays))


def listed(spans: Column, order: list[str], by_kind: bool) -> Column:
    """'kind:start:end' joined by commas, by kind as listed and start, or by start and kind."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, order)), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(
        *([rank(s).alias("a"), s["start"].cast("long").alias("b")] if by_kind else [s["start"].cast("long").alias("a"), rank(s).alias("b")]),
        s["end"].alias("c"), F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")).alias("t")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["t"]), ",")


def masked(text: str, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first
    stands for all of them."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        out = F.when(new, F.concat(acc["out"], F.substr(F.col(text), acc["at"] + 1, s["start"] - acc["at"]),
                                   F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], -s["less"]).alias("at"), out.alias("out"))

    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda a: F.concat(a["out"], F.substr(F.col(text), a["at"] + 1, F.length(F.col(text)))))
    return F.when(F.size(spans) > 0, done).otherwise(F.col(text))
