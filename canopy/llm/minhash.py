"""Near duplicates by fast similarity sketching, banding and exact verification (op 6).

Sketch (t bins): round i hashes every shingle to a value, and for i < t to a random bin, for
i >= t all to bin i - t. A bin keeps its least (round, value). Rounds stop when every bin is full;
after 2 t rounds all are, and mostly one or two do. Equal bins of two sketches estimate the
Jaccard similarity with the concentration bounds of t-fold MinHash.

Candidates share a band of the sketch. Copies of one word sequence are one node throughout. In a
bucket of a band, no list of all pairs is made:

1. every node is compared on full sets with one leader, of its buckets the one it shares most;
2. components of the links found are taken together; only in buckets that hold several components
   are further nodes compared, in blocks, by sketch, and those with enough equal bins on full sets.
   Pairs inside a component can add nothing, so no pair of a bucket that matters is left out.

Null or empty texts, and those without words, are alone in their component. Rows with a null
doc_id are linked with nothing: component_id null, kept true. Repeated rows give a row each. Empty
tables give no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append, aside, counted, map_rows, raw_text, restored, written
from .words import mix, shingles

#: BINS bins estimate similarities; the first BANDS * ROWS of them make the bands. A pair at 0.75 is
#: missed by all bands with probability (1 - 0.75 ** 4) ** 32, or 5e-6.
BINS, BANDS, ROWS = 512, 32, 4
_VALUE, _ROUND = np.uint64(2**45 - 1), np.uint64(45)
_SEEDS = mix(np.arange(1, 2 * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_EMPTY = np.uint64(2**64 - 1)
#: Equal bins from which a pair is verified: 0.75 * 512 less 4.9 standard deviations. A
#: pair at 0.75 falls below with probability 9e-7.
LEAST_EQUAL = 336
QUERY_BLOCK, TARGET_BLOCK = 256, 1024
#: Id tables of up to so many rows (of some 50 bytes) are sent to the texts; beyond, the texts are
#: shuffled to them.
SENT_ROWS = 300_000


def sketch(s: np.ndarray) -> np.ndarray:
    """BINS values of a non-empty set of hashes; (round, value) packed as round << 45 | value."""
    out = np.full(BINS, _EMPTY)
    # several rounds at once for small sets; rounds after the last needed one change nothing
    step, i = max(1, min(BINS, 4096 // len(s))), 0
    while i < BINS and (out == _EMPTY).any():
        rounds = np.arange(i, min(BINS, i + step))
        x = mix(s[None, :] ^ _SEEDS[rounds][:, None])
        own = rounds.astype(np.uint64)[:, None] << _ROUND | (x & _VALUE)
        np.minimum.at(out, (x >> np.uint64(55)).astype(np.int64).ravel(), own.ravel())
        i += step
    for b in np.flatnonzero(out == _EMPTY).tolist():
        x = mix(s ^ _SEEDS[BINS + b])
        out[b] = np.uint64(BINS + b) << _ROUND | (x & _VALUE).min()
    return out


def bands(sk: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of ROWS bins."""
    parts = mix(sk[:BANDS * ROWS] ^ _SEEDS[:BANDS * ROWS]).reshape(-1, ROWS)
    acc = np.arange(1, len(parts) + 1, dtype=np.uint64)
    for j in range(ROWS):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) ^ parts[:, j])
    return acc.view(np.int64)


def content_key(text: bytes) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(text.lower().split()))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key, bands, sketch); the last three are null for texts without words."""

    def rows(it: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in it:
            s = shingles(text)
            if len(s):
                sk = sketch(s)
                low = (sk & np.uint64(0xFF)).astype("u1").tobytes()  # chance equality adds under 0.2 %
                yield doc_id, len(s), content_key(text), bands(sk).tolist(), low
            else:
                yield doc_id, 0, None, None, None

    return map_rows(docs.select("doc_id", raw_text().alias("text")), rows,
                    "doc_id long, n_shingles long, key binary, bands array<long>, sketch binary", ("words",))


def similar(a: np.ndarray, b: np.ndarray, percent: int = 75) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def verify(pairs: DataFrame, texts: DataFrame, percent: int = 75) -> DataFrame:
    """The pairs (a, b) whose full sets are similar. b is the one that may recur often: rows come
    sorted by b, so its set is made once; Spark may split a frequent b over tasks."""
    # no set of a pair can reach the share if their sizes differ too much
    t = texts.select("node", "n", "text")
    p = (pairs.join(t.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("text").alias("ta")), "a")
         .join(t.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("text").alias("tb")), "b")
         .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))

    def rows(it: Iterator[tuple]) -> Iterator[tuple]:
        last, own = None, None
        for a, b, tb, ta in it:
            if b != last:
                last, own = b, shingles(tb)
            if similar(shingles(ta), own, percent):
                yield a, b

    return map_rows(p.select("a", "b", "tb", "ta"), rows, "a long, b long", ("words",))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of all nodes with an edge (a, b); comp is the least node reachable.

    Each round takes the least label among neighbours, then follows labels one step further. Frequent
    nodes are pre-aggregated by Spark's partial aggregates; tables in the shared folder cut lineage.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                   "edges", narrow=True)
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("comp")), "labels", narrow=True)
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        nxt = written(labels.join(near, "node").join(up, "comp")
                      .select("node", F.least("comp", "near", "up").alias("comp"), F.col("comp").alias("old")), "labels", narrow=True)
        if nxt.filter("comp <> old").isEmpty():
            return nxt.select("node", "comp")
        labels = nxt.select("node", "comp")


def mixed_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) in a common bucket but different components whose sketches agree enough.

    `members` (band, node, comp). Within a bucket, nodes outside its largest component are compared
    with all others, in blocks of bounded size, inside one task each. A pair is reported in the first
    band that its nodes share, so once.
    """
    sizes = members.groupBy("band", "comp").agg(F.count("*").alias("n"))
    mixed = (sizes.groupBy("band").agg(F.sum("n").alias("m"), F.count("*").alias("k"),
                                       F.max(F.struct("n", "comp")).alias("top"))
             .filter("k > 1")
             .select("band", F.col("top.comp").alias("main"), F.col("m"), (F.col("m") - F.col("top.n")).alias("o")))
    rows_ = (members.join(mixed, "band")
             .withColumn("is_q", F.col("comp") != F.col("main"))
             .withColumn("h", F.abs(F.xxhash64("node") % (1 << 40)))
             .withColumn("qn", F.ceil(F.col("o") / QUERY_BLOCK)).withColumn("tn", F.ceil(F.col("m") / TARGET_BLOCK)))
    as_target = rows_.withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qn").cast("int") - 1))) \
        .withColumn("tb", (F.col("h") % F.col("tn")).cast("int")).withColumn("role", F.lit(1))
    as_query = rows_.filter("is_q").withColumn("tb", F.explode(F.sequence(F.lit(0), F.col("tn").cast("int") - 1))) \
        .withColumn("qb", (F.col("h") % F.col("qn")).cast("int")).withColumn("role", F.lit(0))
    cols = ["band", "qb", "tb", "role", "node", "comp", "main"]
    blocks = as_target.select(*cols).union(as_query.select(*cols)).join(nodes.select("node", "bands", "sketch"), "node")

    def rows(it: Iterator[tuple]) -> Iterator[tuple]:
        for (band, _, _), group in itertools.groupby(it, key=lambda r: r[:3]):
            g = list(group)
            q, t = [r for r in g if r[3] == 0], [r for r in g if r[3] == 1]
            if not q or not t:
                continue
            main = g[0][6]
            tn, tc = np.array([r[4] for r in t]), np.array([r[5] for r in t])
            tb = np.array([r[7] for r in t])
            ts = np.frombuffer(b"".join(r[8] for r in t), "u1").reshape(len(t), BINS)
            for r in q:
                # two nodes outside the main component meet twice: take the pair once
                ask = np.flatnonzero((tc != r[5]) & ((tc == main) | (tn < r[4])))
                if len(ask):
                    own = np.array(r[7])
                    ask = ask[(tb[ask] == own).argmax(axis=1) == int((own == band).argmax())]
                    equal = (ts[ask] == np.frombuffer(r[8], "u1")).sum(axis=1)
                    for n in tn[ask][equal >= LEAST_EQUAL].tolist():
                        yield (r[4], n) if r[4] > n else (n, r[4])

    dealt = blocks.select(*cols, "bands", "sketch").repartition("band", "qb", "tb").sortWithinPartitions("band", "qb", "tb")
    return map_rows(dealt, rows, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    return _found(docs, percent).select("doc_id", "n_shingles", "component_id",
                                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _found(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n_shingles, key, component_id, stays) of every row; `stays` is true for the rows of
    one (doc_id, key) of each component, and for those that are linked with nothing."""
    sig = written(signatures(docs), "signatures")
    known = sig.filter("key IS NOT NULL AND doc_id IS NOT NULL")
    nodes = written(known.groupBy("key").agg(F.min("doc_id").alias("rep"),
                                             F.min_by(F.struct("bands", "sketch", "n_shingles"), "doc_id").alias("s"))
                    .select(F.monotonically_increasing_id().alias("node"), "key", "rep", "s.*"), "nodes")
    keys = nodes.select("node", F.explode("bands").alias("band"))
    # shared buckets only; a node's weight is the number of nodes it shares buckets with
    sizes = keys.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    members = written(keys.join(sizes, "band"), "members")
    weights = members.groupBy("node").agg(F.sum("n").alias("w"))
    # the leader of a bucket is its node with most company: the middle of a cloud of near copies
    leaders = (members.join(weights, "node").groupBy("band").agg(F.max(F.struct("w", "node")).alias("top"))
               .select("band", F.col("top.node").alias("leader")))
    stars = (members.join(leaders, "band").filter("node <> leader").groupBy("node", "leader").agg(F.count("*").alias("shared"))
             .groupBy("node").agg(F.max(F.struct("shared", "leader")).alias("best"))
             .select(F.col("node").alias("a"), F.col("best.leader").alias("b")))
    stars = written(stars, "stars", narrow=True)
    needed = written(members.select("node").distinct().join(
        nodes.select("node", "key", F.col("rep").alias("doc_id"), "n_shingles"), "node"), "needed", narrow=True)
    texts = written(_texts(docs, needed), "texts")
    links = written(verify(stars, texts, percent), "links")
    comp = components(links)
    known_members = (members.select("band", "node").join(comp, "node", "left")
                     .select("band", "node", F.coalesce("comp", "node").alias("comp")))
    more = written(mixed_pairs(known_members, nodes).join(
        stars.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), ["a", "b"], "left_anti"), "pairs")
    if not more.isEmpty():
        second = written(verify(more, texts, percent), "links")
        if not second.isEmpty():
            comp = components(links.union(second))
    named = nodes.select("node", "key", "rep").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = named.groupBy("comp").agg(F.min(F.struct("rep", "node")).alias("top"))
    # only nodes of several need the second join; most are alone
    of_key = named.join(least, "comp").select("key", F.col("top.rep").alias("component_id"), (F.col("node") == F.col("top.node")).alias("first"))
    out = sig.select("doc_id", "n_shingles", "key").join(of_key, "key", "left")
    return out.select(
        "doc_id", "n_shingles", "key",
        F.when(F.col("doc_id").isNull(), F.lit(None).cast("long"))
        .otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.coalesce(F.col("first") & (F.col("doc_id") == F.col("component_id")), F.lit(True)).alias("stays"))


def keep_one(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The documents without those that duplicate another; all columns stay.

    A document is a doc_id with its words: of rows that repeat both one stays, and texts that share
    a doc_id are judged one by one.
    """
    found = written(_found(docs, percent), "near-duplicates").filter("doc_id IS NOT NULL")
    ids = written(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_or("stays").alias("stays"))
                  .filter("n > 1 OR NOT stays").select("doc_id", "n"), "ids", narrow=True)
    out = docs.join(counted(ids.select("doc_id"), SENT_ROWS), "doc_id", "left_anti").select(*docs.columns)
    twice = ids.filter("n > 1").select("doc_id")
    if not twice.isEmpty():
        twice = counted(twice, SENT_ROWS)
        named = [f"_col{i}" for i in range(len(docs.columns))]
        own = named[docs.columns.index("doc_id")]
        pairs = (found.filter("stays").join(twice, "doc_id", "left_semi")
                 .select(F.col("doc_id").alias(own), F.coalesce("key", F.lit(b"")).alias("key")).distinct())
        again = append(aside(docs.join(twice, "doc_id", "left_semi").select(*docs.columns)), named[docs.columns.index("text")],
                       lambda texts: [(content_key(t) if t and t.split() else b"",) for t in texts], "key binary", named, ("words",))
        again = again.join(pairs, [own, "key"], "left_semi").dropDuplicates([own, "key"])
        out = out.unionByName(restored(again, docs.columns))
    return out


def _texts(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(node, n, text) of the nodes' representatives; rows of the same doc_id with another text go."""
    own = docs.select("doc_id", raw_text().alias("text"))
    nodes = needed.select("doc_id", "node", "key", F.col("n_shingles").alias("n"))
    several = written(nodes.groupBy("doc_id").agg(F.count("*").alias("nodes")).filter("nodes > 1").select("doc_id"), "several", narrow=True)
    some = not several.isEmpty()
    single = nodes.join(several, "doc_id", "left_anti") if some else nodes
    found = own.join(counted(single, SENT_ROWS), "doc_id").dropDuplicates(["doc_id", "node", "text"])

    def rows(it: Iterator[tuple]) -> Iterator[tuple]:
        for node, n, key, text in it:
            if text is not None and content_key(text) == key:
                yield node, n, text

    out = map_rows(found.select("node", "n", "key", "text"), rows, "node long, n long, text binary", ("words",))
    if not some:
        return out

    def keyed(it: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in it:
            if text is not None:
                yield doc_id, content_key(text), text

    # ids of several nodes: the key comes first, so that each text meets its own node alone
    several = counted(several, SENT_ROWS)
    texts = map_rows(own.join(several, "doc_id", "left_semi").select("doc_id", "text"), keyed,
                     "doc_id long, key binary, text binary", ("words",))
    met = texts.join(nodes.join(several, "doc_id", "left_semi"), ["doc_id", "key"]).dropDuplicates(["node", "text"])
    return out.unionByName(met.select("node", "n", "text"))
