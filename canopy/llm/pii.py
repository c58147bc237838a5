"""Personal data by weak supervision (op 8); DataFrame functions only.

Base kinds: `email`, `ip`, `card`, `phone`, by pattern and check. The method looks at more
candidates: `number` (card-like digits that fail the checksum), `local` (telephone numbers without
a country code), `id` (3-2-4 digit numbers) and `mail` (addresses with a written-out at sign).

Five labelers vote on every candidate, base ones included: its shape (regex), a gazetteer, the
checksum, the words before it, and what touches it. Each says personal (1), not (-1) or nothing
(0). Expectation-maximisation estimates, from how often the labelers' votes occur together, how
each votes on personal and on other spans, and so a probability per vote pattern. A logistic span
classifier is then trained on these probabilities, with features of the span itself, and judges the
candidates that are not base: those with a probability of THRESHOLD or more are added. Base spans
always stay.

Votes and features take few values, so candidates are counted per combination before either fit:
the fits work on a table of bounded size (at most 3^5 votes times the feature combinations), built
by one aggregation over all documents; only sums of it reach the driver. Without candidates, or if
all are of one opinion, there is no classifier and nothing is added.

Null text is empty. Rows are judged one by one: repeated rows give equal rows, an empty table none.
Only doc_id and text are read (all columns are kept by `redact`).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans
from .common import aside, restored, written

BASE = ["email", "ip", "card", "phone"]
EXTRA = ["number", "local", "id", "mail"]
KINDS = BASE + EXTRA
# The base patterns. A look-behind or \G starts each try at the head of its run, and
# possessive quantifiers end it there; the matches are those of the plain patterns.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LOCAL = r"(?<![0-9A-Za-z+.)-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9A-Za-z])"
ID = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
MAIL = r"[A-Za-z0-9._%+-]{1,64}+\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]{1,63}+)++"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# Gazetteers and context words of the labelers.
TOP_DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|us|ca|ch|at|nl|be|pl|pt|br|mx|jp|cn|in|ru|au"
COUNTRY_CODES = "1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|54|55|56|57|60|61|62|63|64|65|66|81|82|84|86|90|91"
SAYS_PERSONAL = r"(?i)\b(phone|tel|telephone|fax|mobile|call|contact|e-?mail|mail|card|visa|ssn|social|konto|telefon|handy|tarjeta|correo|tel[eé]fono|carte|courriel|t[eé]l[eé]phone)\b"
SAYS_OTHER = r"(?i)(\b(version|v|page|pages|isbn|issn|section|chapter|fig|table|no|nr|order|total|price|sku|id)\b|[$€£#§=])[\s.:]*$"
LABELERS = ["v_shape", "v_list", "v_sum", "v_words", "v_edge"]
FEATURES = [*("f_" + k for k in KINDS), "f_long", "f_parts", "f_same", "f_zero", "f_space", "f_edge", "f_one"]
CONTEXT, EM_STEPS, FIT_STEPS, THRESHOLD, RIDGE = 24, 15, 30, 0.9, 1.0


def candidates(docs: DataFrame) -> DataFrame:
    """Adds `base` and `more`, arrays of spans, and the text without null as `_t`."""
    df = docs.withColumn("_t", F.coalesce(F.col("text"), F.lit("")))
    digit = F.col("_t").rlike("[0-9]")
    has = lambda s: F.contains(F.col("_t"), F.lit(s))
    plan = {"email": (EMAIL, has("@")), "ip": (IP, digit), "card": (CARD, digit), "phone": (PHONE, has("+")),
            "local": (LOCAL, digit), "id": (ID, digit), "mail": (MAIL, F.col("_t").rlike(r"[(\[]at[)\]]"))}
    for kind, (regex, only) in plan.items():
        df = df.withColumn(f"_m_{kind}", spans.matches("_t", regex, only=only))
    for kind, (regex, _) in plan.items():
        df = df.withColumn(f"_g_{kind}", spans.gaps("_t", regex, f"_m_{kind}"))
    for kind in plan:
        df = df.withColumn(f"_s_{kind}", spans.place(kind, f"_m_{kind}", f"_g_{kind}"))
    n = lambda s: F.length(spans.digits(s["match"]))
    sums = lambda s: n(s).between(13, 19) & spans.luhn(spans.digits(s["match"]))
    part = f"^{PART}(?:\\.{PART}){{3}}$"
    df = df.withColumn("base", F.concat(
        F.col("_s_email"), F.filter("_s_ip", lambda s: s["match"].rlike(part)), F.filter("_s_card", sums),
        F.filter("_s_phone", lambda s: n(s).between(9, 15))))
    numbers = F.transform(F.filter("_s_card", lambda s: n(s).between(13, 19) & ~sums(s)),
                          lambda s: s.withField("kind", F.lit("number")))
    free = F.filter(F.concat(numbers, F.col("_s_local"), F.col("_s_id"), F.col("_s_mail")),
                    lambda x: ~F.exists(F.col("base"), lambda b: spans.overlaps(x, b)))
    # of overlapping candidates the first, in the order above, stands
    df = df.withColumn("_free", free)
    alone = F.filter(F.col("_free"), lambda x, i: ~F.exists(
        F.slice(F.col("_free"), F.lit(1), i), lambda e: spans.overlaps(x, e)))
    df = df.withColumn("more", F.when(F.size("_free") > 0, alone).otherwise(spans.none()))
    return df.select(*docs.columns, "_t", "base", "more")


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def judged(df: DataFrame) -> DataFrame:
    """Adds `cands`: per candidate its kind, place, whether base, the votes and the features."""

    def one(s: Column, base: Column) -> Column:
        m, kind, d = s["match"], s["kind"], spans.digits(s["match"])
        n = F.length(d)
        is_ = lambda *k: kind.isin(*k)
        before = F.substr(F.col("_t"), F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT)))
        left, right = F.substr(F.col("_t"), s["start"], F.lit(1)), F.substr(F.col("_t"), s["end"] + 1, F.lit(1))
        left = F.when(s["start"] > 0, left).otherwise(F.lit(""))
        same = d.rlike(r"^([0-9])\1*$") & (n > 0)
        shape_ok = (is_("email") & m.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@.*\.[A-Za-z]{2,24}$")
                    | is_("ip") & m.rlike(r"^(?:(?:0|[1-9][0-9]*)\.){3}(?:0|[1-9][0-9]*)$")
                    | is_("card", "number") & m.rlike(r"^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,4})?)$")
                    | is_("phone", "local") & m.rlike(r"[ ().-]") & n.between(9, 15)
                    | is_("id") & ~m.rlike(r"^(?:000|666|9)|-00-|-0000$") | is_("mail"))
        shape_bad = same | is_("local") & (n < 9) | is_("id") & m.rlike(r"^(?:000|666|9)|-00-|-0000$")
        list_ok = (is_("email", "mail") & m.rlike(rf"(?i)(?:\.|dot[)\]]\x20?)(?:{TOP_DOMAINS})$")
                   | is_("phone") & m.rlike(rf"^\+(?:{COUNTRY_CODES})[^0-9]")
                   | is_("card", "number") & d.rlike("^(?:4|5[1-5]|3[47]|6011|65|35|36|2[2-7])"))
        list_bad = (is_("ip") & m.rlike(r"^(?:0|10|127|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168|2(?:2[4-9]|[34][0-9]|5[0-5]))\.")
                    | is_("card", "number") & d.rlike("^[0789]")
                    | is_("email") & m.rlike(r"(?i)@(?:localhost|.*\.(?:invalid|test|local))$"))
        luhn = spans.luhn(d)
        touch = lambda c: c.rlike(r"[\p{L}0-9_/\\@=-]")
        edge_bad = touch(left) | touch(right)
        edge_ok = (left.rlike(r"^[\s(\[<:,;\"']?$")) & right.rlike(r"^[\s.,;:!?)\]>\"']?$")
        votes = {"v_shape": _vote(shape_ok, shape_bad), "v_list": _vote(list_ok, list_bad),
                 "v_sum": _vote(is_("card", "number") & luhn, is_("card", "number") & ~luhn),
                 "v_words": _vote(before.rlike(SAYS_PERSONAL), before.rlike(SAYS_OTHER)),
                 "v_edge": _vote(edge_ok, edge_bad)}
        feats = {**{f"f_{k}": kind == k for k in KINDS}, "f_long": n >= 13, "f_parts": m.rlike(r"[0-9][ .()-]+[0-9]"),
                 "f_same": same, "f_zero": d.rlike("^0"), "f_space": left.rlike(r"^\s?$"), "f_edge": touch(left) | touch(right),
                 "f_one": F.lit(True)}
        return F.struct(kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end"), base.alias("base"),
                        *(v.cast("int").alias(k) for k, v in votes.items()), *(v.cast("int").alias(k) for k, v in feats.items()))

    base = F.transform("base", lambda s: F.struct(s.alias("s"), F.lit(True).alias("base")))
    more = F.transform("more", lambda s: F.struct(s.alias("s"), F.lit(False).alias("base")))
    return df.withColumn("cands", F.transform(F.concat(base, more), lambda x: one(x["s"], x["base"])))


@dataclass
class Model:
    """How each labeler votes on personal (1) and other (0) spans, and the span classifier."""

    prior: float
    votes: dict[tuple[str, int, int], float]
    weights: dict[str, float]

    def label(self) -> Column:
        """The probability of a vote pattern."""
        logit = F.lit(math.log(self.prior / (1 - self.prior)))
        for name in LABELERS:
            ratio = {v: math.log(self.votes[name, v, 1] / self.votes[name, v, 0]) for v in (-1, 0, 1)}
            logit = logit + F.when(F.col(name) == 1, ratio[1]).when(F.col(name) == 0, ratio[0]).otherwise(ratio[-1])
        return _sigmoid(logit)

    def probability(self, s: Column) -> Column:
        return _sigmoid(sum((s[f] * w for f, w in self.weights.items()), F.lit(0.0)))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), x))))


def patterns(cands: DataFrame) -> DataFrame:
    """Counts of each combination of votes and features over all candidates."""
    rows = cands.select(F.explode("cands").alias("c")).select("c.*")
    return written(rows.groupBy(*LABELERS, *FEATURES).agg(F.count("*").alias("n")), "vote-patterns")


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(rows: Column, term) -> Column:
    return F.aggregate(rows, F.lit(0.0), lambda acc, r: acc + term(r))


def _label(theta: Column, votes: Column) -> Column:
    """The probability of a vote pattern. theta: the prior, then for labeler k, vote v and class y the
    share at 2 + 6 k + 2 (v + 1) + y."""
    logit = F.log(F.element_at(theta, 1) / (1 - F.element_at(theta, 1)))
    for k in range(len(LABELERS)):
        at = 6 * k + 2 * (F.element_at(votes, k + 1) + 1)
        logit = logit + F.log(F.element_at(theta, at + 3) / F.element_at(theta, at + 2))
    return _sigmoid(logit)


def fit(table: DataFrame) -> Model | None:
    """EM over the vote patterns, then the classifier on the probabilities they get.

    The table's rows, a few hundred combinations, are one array; each step is an expression over it,
    so both fits are one query, and what it returns is the model.
    """
    both = table.select("n", F.array(*LABELERS).alias("v"), F.array(*FEATURES).alias("f"))
    row = both.agg(F.collect_list(F.struct(F.col("n").cast("double").alias("n"), "v", "f")).alias("rows")).filter(F.size("rows") > 0)
    votes = F.col("votes")
    row = row.withColumn("votes", F.transform(F.array_distinct(F.transform("rows", lambda r: r["v"])), lambda v: F.struct(
        v.alias("v"), _total(F.filter("rows", lambda r: r["v"] == v), lambda r: r["n"]).alias("n"))))

    def shares(rows: Column) -> Column:
        """The M step: rows (n, v, p) to the prior and the vote shares, each smoothed by one count."""
        one, total = _total(rows, lambda r: r["n"] * r["p"]), _total(rows, lambda r: r["n"])
        out = [(one + 1) / (total + 2)]
        for k in range(len(LABELERS)):
            for v in (-1, 0, 1):
                for y in (0, 1):
                    hit = _total(rows, lambda r, k=k, v=v, y=y: F.when(
                        F.element_at(r["v"], k + 1) == v, r["n"] * (r["p"] if y else 1 - r["p"])).otherwise(0.0))
                    out.append((hit + 1) / ((one if y else total - one) + 3))
        return F.array(*out)

    def labelled(p) -> Column:
        return F.transform(votes, lambda r: F.struct(r["n"].alias("n"), r["v"].alias("v"), p(r).alias("p")))

    # start: the labelers' majority
    majority = lambda r: _sigmoid(F.aggregate(r["v"], F.lit(0), lambda a, v: a + v).cast("double"))
    step = lambda theta: _let(labelled(lambda r: _label(theta, r["v"])), shares)
    row = row.withColumn("theta", F.aggregate(F.sequence(F.lit(2), F.lit(EM_STEPS)), _let(labelled(majority), shares), lambda t, _: step(t)))
    # distinct features with the mean probability of their votes
    row = row.withColumn("soft", F.transform("rows", lambda r: F.struct(
        r["n"].alias("n"), r["f"].alias("f"), _label(F.col("theta"), r["v"]).alias("p"))))
    size = F.array(*(_total(F.col("soft"), lambda r, j=j: r["n"] * F.element_at(r["f"], j + 1)) for j in range(len(FEATURES))))
    row = row.withColumn("size", size)
    active = 8  # features of a span that are 1: its kind and at most seven more

    def descend(w: Column) -> Column:
        """One step of an upper bound of the curvature: the loss falls at each."""
        z = lambda r: F.aggregate(F.arrays_zip(r["f"].alias("f"), w.alias("w")), F.lit(0.0), lambda a, x: a + x["f"] * x["w"])
        off = F.transform(F.col("soft"), lambda r: F.struct((r["n"] * (_sigmoid(z(r)) - r["p"])).alias("g"), r["f"].alias("f")))
        return _let(off, lambda rows: F.transform(w, lambda x, j: x - (
            _total(rows, lambda r: r["g"] * F.element_at(r["f"], j + 1)) + RIDGE * x)
            / (active * F.element_at(F.col("size"), j + 1) / 4 + RIDGE)))

    row = row.withColumn("w", F.aggregate(F.sequence(F.lit(1), F.lit(FIT_STEPS)), F.array_repeat(F.lit(0.0), len(FEATURES)), lambda w, _: descend(w)))
    found = row.select("theta", "w").first()
    if found is None:
        return None
    votes_of = {(x, v, y): found.theta[1 + 6 * k + 2 * (v + 1) + y] for k, x in enumerate(LABELERS) for v in (-1, 0, 1) for y in (0, 1)}
    return Model(found.theta[0], votes_of, dict(zip(FEATURES, found.w, strict=True)))


def decide(df: DataFrame, model: Model | None) -> DataFrame:
    """Replaces `cands` by `found`: base spans, and others the classifier takes for personal."""
    take = lambda s: s["base"] | (model.probability(s) >= THRESHOLD if model else F.lit(False))
    slim = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"))
    return df.withColumn("found", F.transform(F.filter("cands", take), slim)).drop("cands")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, hash of the base spans, and all spans."""
    cands = written(judged(candidates(docs.select("doc_id", "text"))).select("doc_id", "cands"), "pii-candidates")
    found = decide(cands, fit(patterns(cands)))
    found = found.withColumn("base", F.filter("found", lambda s: s["base"]))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in BASE),
                        F.sha2(spans.listed(F.col("base"), KINDS, by_kind=True), 256).alias("base_sha256"),
                        spans.listed(F.col("found"), KINDS, by_kind=True).alias("spans"))


def redact(docs: DataFrame, text_length: str | None = None) -> DataFrame:
    """The documents with every found span masked; all columns stay. `text_length` names a column
    that holds the text's length and follows it."""
    # the texts are scanned once; what is read again are the rows with their few candidates
    seen = judged(candidates(aside(docs, "text").drop(f"_col{docs.columns.index('text')}"))).drop("_t", "base", "more")
    seen = written(seen, "pii-scanned")
    found = decide(seen, fit(patterns(seen.select("cands")))).withColumn("_t", F.coalesce("text", F.lit("")))
    hit = F.size("found") > 0
    found = found.withColumn("_new", F.when(hit, spans.masked("_t", F.col("found"))).otherwise(F.col("text")))
    changed = {"text": F.col("_new")}
    if text_length in docs.columns:
        own = F.col(f"_col{docs.columns.index(text_length)}")
        changed[text_length] = F.when(hit, F.length("_new").cast(docs.schema[text_length].dataType)).otherwise(own)
    return restored(found, docs.columns, **changed)
