"""Secret scan with sliding-window Shannon entropy (op 3); DataFrame functions only.

Base kinds: `assign` (a named assignment of a value of 12 or more characters), `access` (access key
ids) and `hex` (runs of 16 or more). The method adds `entropy` spans: candidate strings are runs of
20 or more key characters. A window slides over such a run; the counts of its characters and the
sum of c * log2(c) are updated by the one character that enters and the one that leaves, so a step
costs the alphabet's size and not the window's. The run's character class (hex digits, upper-case
and digits, or mixed) sets window and threshold; the span reaches from the first window over the
threshold to the last. Base spans, and path segments that hold a placeholder word, are cut out of a
run, and each piece of 20 or more characters between them is a candidate of its own. Candidates that
an allow-list pattern covers (words, numbers, paths, UUIDs) add nothing.

Null text is empty. Rows are judged one by one: repeated rows give equal rows, an empty table none.
Only doc_id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans
from .common import aside

KINDS = ["assign", "access", "hex", "entropy"]
# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"  # the longest run, 18 characters or more
HEX = r"[0-9a-f]{16,}+"
# Candidate strings, and per character class: pattern, window, least entropy in bits.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"
CLASSES = {"hex": (r"^[0-9a-fA-F]+$", 16, 2.75), "upper": (r"^[A-Z0-9]+$", 20, 3.4), "mixed": (r"", 20, 3.7)}
#: Candidates that one of these matches are no secrets.
ALLOW = (
    r"^[A-Za-z]+$", r"^[0-9_=+/-]+$", r"^[A-Za-z]++(?:[-_/=+]++[A-Za-z]*+)++[0-9]{0,4}$", r"^(.)\1+$",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
)
#: Words of placeholders; the path segment around one is no secret, what lies beside it may be.
PLACEHOLDER = r"(?i)(?:example|placeholder|changeme|dummy|sample|your[_-]?(?:key|token|secret))"
LEAST = 20
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"


def hot_range(s: Column, window: Column, least: Column, longest: int = 20) -> Column:
    """struct(first, last): code points from the first window whose entropy reaches `least` to the
    end of the last such window; last is 0 if there is none.

    With counts c of a full window of w characters, entropy = log2(w) - sum(c log2 c) / w.
    """
    f = F.array(*(F.lit(k * math.log2(k) if k else 0.0) for k in range(longest + 2)))
    alphabet = F.lit(ALPHABET)
    at = lambda counts, i: F.element_at(counts, i)

    def step(acc: Column, i: Column) -> Column:
        enters = F.instr(alphabet, F.substr(s, i, F.lit(1)))
        leaves = F.when(i > window, F.instr(alphabet, F.substr(s, i - window, F.lit(1)))).otherwise(F.lit(0))
        c, sum_ = acc["c"], acc["sum"]
        k_in = at(c, enters)
        k_out = F.when(leaves > 0, at(c, leaves)).otherwise(F.lit(0))
        # one character in, one out; if they are the same, nothing changes
        moved = F.when(enters == leaves, sum_).otherwise(
            sum_ + at(f, k_in + 2) - at(f, k_in + 1)
            + F.when(leaves > 0, at(f, k_out) - at(f, k_out + 1)).otherwise(F.lit(0.0)))
        counts = F.transform(c, lambda k, j: k + F.when(j + 1 == enters, 1).otherwise(0) - F.when(j + 1 == leaves, 1).otherwise(0))
        hot = (i >= window) & (F.log2(window.cast("double")) - moved / window >= least)
        return F.struct(counts.alias("c"), moved.alias("sum"),
                        F.when(hot & (acc["last"] == 0), i - window).otherwise(acc["first"]).alias("first"),
                        F.when(hot, i).otherwise(acc["last"]).alias("last"))

    start = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("c"), F.lit(0.0).alias("sum"),
                     F.lit(0).alias("first"), F.lit(0).alias("last"))
    return F.aggregate(F.sequence(F.lit(1), F.length(s)), start, step,
                       lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))


def _by_class(s: Column, value: int) -> Column:
    out = F.lit(CLASSES["mixed"][value])
    for name in ("upper", "hex"):
        out = F.when(s.rlike(CLASSES[name][0]), F.lit(CLASSES[name][value])).otherwise(out)
    return out


def pieces(run: Column, cuts: Column) -> Column:
    """The parts of a span that no span of `cuts` covers, if they are LEAST characters or longer."""
    at = F.struct(run["start"].alias("at"), spans.none().alias("out"))

    def part(begin: Column, end: Column) -> Column:
        text = F.substr(run["match"], begin - run["start"] + 1, end - begin)
        span = F.struct(run["kind"].alias("kind"), begin.alias("start"), end.alias("end"), text.alias("match"), run["group"].alias("group"))
        return F.when(end - begin >= LEAST, F.array(span)).otherwise(spans.none())

    def step(acc: Column, cut: Column) -> Column:
        return F.struct(F.greatest(acc["at"], cut["end"]).alias("at"), F.concat(acc["out"], part(acc["at"], cut["start"])).alias("out"))

    inside = F.array_sort(F.transform(F.filter(cuts, lambda c: spans.overlaps(run, c)),
                                      lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"))))
    return F.aggregate(inside, at, step, lambda acc: F.concat(acc["out"], part(acc["at"], run["end"])))


def scan(docs: DataFrame, allow: tuple[str, ...] = ALLOW, placeholder: str = PLACEHOLDER) -> DataFrame:
    """Adds `base` and `secrets` (all spans) to the documents, as arrays of spans; columns of these
    names are replaced."""
    df = aside(docs, "text").withColumn("_t", F.coalesce(F.col("text"), F.lit("")))
    df = (df.withColumn("_am", spans.matches("_t", ASSIGN))
          .withColumn("_ag", spans.matches("_t", ASSIGN, 2, only=F.size("_am") > 0))
          .withColumn("_cm", spans.matches("_t", ACCESS, only=F.contains(F.col("_t"), F.lit("AKIA"))))
          .withColumn("_hm", spans.matches("_t", HEX)).withColumn("_em", spans.matches("_t", CANDIDATE)))
    for name, regex in (("a", ASSIGN), ("c", ACCESS), ("h", HEX), ("e", CANDIDATE)):
        df = df.withColumn(f"_{name}g2", spans.gaps("_t", regex, f"_{name}m"))
    df = (df.withColumn("_as", F.filter(spans.place("assign", "_am", "_ag2", "_ag"), lambda x: F.length(x["group"]) >= 12))
          .withColumn("_cs", spans.place("access", "_cm", "_cg2")).withColumn("_hs", spans.place("hex", "_hm", "_hg2"))
          .withColumn("base", spans.merged(["_as", "_cs", "_hs"])))
    # the whole segment around a placeholder word; tries start at a segment's head only
    segment = rf"(?<![A-Za-z0-9+_=-])[A-Za-z0-9+_=-]*{placeholder}[A-Za-z0-9+_=-]*+"
    df = df.withColumn("_pm", spans.matches("_t", segment, only=(F.size("_em") > 0) & F.col("_t").rlike(placeholder)))
    df = df.withColumn("_pg", spans.gaps("_t", segment, "_pm"))
    df = df.withColumn("_cuts", F.concat("base", spans.place("placeholder", "_pm", "_pg")))
    runs = F.flatten(F.transform(spans.place("entropy", "_em", "_eg2"), lambda x: pieces(x, F.col("_cuts"))))
    df = df.withColumn("_free", F.when(F.size("_em") > 0, F.filter(runs, lambda x: ~_any(x["match"], allow))).otherwise(spans.none()))
    ranged = F.transform(F.col("_free"), lambda x: F.struct(x.alias("x"), hot_range(
        x["match"], _by_class(x["match"], 1), _by_class(x["match"], 2)).alias("r")))
    df = df.withColumn("_ranged", F.when(F.size("_free") > 0, ranged))
    hot = F.transform(F.filter(F.col("_ranged"), lambda y: y["r"]["last"] > 0), lambda y: F.struct(
        y["x"]["kind"].alias("kind"), (y["x"]["start"] + y["r"]["first"]).alias("start"), (y["x"]["start"] + y["r"]["last"]).alias("end"),
        F.substr(y["x"]["match"], y["r"]["first"] + 1, y["r"]["last"] - y["r"]["first"]).alias("match"), F.lit(None).cast("string").alias("group")))
    df = df.withColumn("secrets", F.concat(F.col("base"), F.coalesce(hot, spans.none())))
    stay = [(f"_col{i}", c) for i, c in enumerate(docs.columns) if c not in ("base", "secrets")]
    return df.select(*(F.col(a).alias(c) for a, c in stay), "base", "secrets")


def _any(s: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | s.rlike(p)
    return out


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, hash of the base spans, and all spans."""
    found = scan(docs.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
                        F.sha2(spans.listed(F.col("base"), KINDS, by_kind=False), 256).alias("base_sha256"),
                        spans.listed(F.col("secrets"), KINDS, by_kind=False).alias("spans"))
