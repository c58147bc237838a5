import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from canopy.llm import chat as C
from canopy.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def legal(roles):
    r = roles[1:] if roles[:1] == ["system"] else roles
    return len(r) % 2 == 0 and len(r) > 0 and all(x == ("user", "assistant")[i % 2] for i, x in enumerate(r))


def cheapest(roles, most=3):
    """Least cost by trying every labelling, every set of merges and every placing of empty turns."""
    best = None
    n = len(roles)
    for labels in itertools.product(C.ROLES, repeat=n):
        cost = sum(C.RELABEL for a, b in zip(roles, labels, strict=True) if a != b)
        for merges in itertools.product((0, 1), repeat=n - 1):
            if any(m and labels[i] != labels[i + 1] for i, m in enumerate(merges)):
                continue
            turns = [labels[0], *(x for x, m in zip(labels[1:], merges, strict=True) if not m)]
            c = cost + C.MERGE * sum(merges)
            for k in range(most + 1):
                if best is not None and c + C.INSERT * k >= best:
                    break
                if any(legal(put(turns, at, what)) for at in itertools.combinations_with_replacement(range(len(turns) + 1), k)
                       for what in itertools.product(("user", "assistant"), repeat=k)):
                    best = c + C.INSERT * k
                    break
    return best


def put(turns, at, what):
    out = list(turns)
    for p, w in sorted(zip(at, what, strict=True), key=lambda x: -x[0]):
        out.insert(p, w)
    return out


def parse(segments):
    return [x.split("\n", 1)[0].rstrip("|>") for x in "".join(segments).split("<|")[1:]]


def conversations(seed, n):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "tool"]
    return [[rnd.choice(roles[:2] * 3 + roles) for _ in range(rnd.randint(1, 4))] for _ in range(n)]


def run(spark, convs):
    rows = [(i, k, r, f"t{i}.{k}") for i, c in enumerate(convs) for k, r in enumerate(c)]
    got = {}
    for r in C.repair(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.conv_id, []).append(r)
    return {k: sorted(v, key=lambda r: r.position) for k, v in got.items()}


def test_least_cost(spark):
    convs = conversations(1, 60) + [["user"], ["assistant"], ["system"], ["assistant", "user", "system"], ["user", "user", "user"]]
    got = run(spark, convs)
    for i, c in enumerate(convs):
        rows = got[i]
        assert len(rows) == len(c) and legal(parse(r.segment for r in rows)), (c, rows)
        assert sum(r.cost for r in rows) == cheapest([x if x in C.ROLES else "?" for x in c]), c
        text = "".join(r.segment for r in rows)
        places = [text.index(f"t{i}.{k}") for k in range(len(c))]
        assert places == sorted(places)


def test_clean_conversations_stay(spark):
    got = run(spark, [["system", "user", "assistant"], ["user", "assistant", "user", "assistant"]])
    assert all(r.action == "append" and r.cost == 0 and r.role_in == r.role_out for v in got.values() for r in v)
    assert "".join(r.segment for r in got[0]) == "<|system|>\nt0.0\n<|user|>\nt0.1\n<|assistant|>\nt0.2\n"


def test_one_conversation_over_many_partitions(spark):
    """The result does not depend on how a long conversation is cut."""
    rnd = random.Random(9)
    roles = [rnd.choice(["user", "user", "assistant", "tool", None, "system"]) for _ in range(3000)]
    rows = [(7, k, r, f"t{k}") for k, r in enumerate(roles)] + [(8, k, "user", "x") for k in range(5)] + [(None, 0, "user", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    own = list(C.walk([C._known(r) for r in roles], C.START, C.AT_END))
    for n in ("3", "40"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = C.repair(df).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
        assert len(got) == len(rows)
        mine = sorted((r for r in got if r.conv_id == 7), key=lambda r: r.position)
        assert [(r.turn, r.action, r.role_out) for r in mine] == [(k, o[1], C.ROLES[o[3] - 1]) for k, o in enumerate(own)]
        assert legal(parse(r.segment for r in mine))
        assert sum(r.cost for r in mine) == sum(o[0] for o in own) + C.AT_END[own[-1][3]]
        assert [r.segment for r in got if r.conv_id is None] == ["<|user|>\n\n<|assistant|>\n\n"]


def test_query(spark, sf):
    rows = QUERIES["op9_role_repair"](spark, sf).collect()
    assert len(rows) == duckdb.sql(f"SELECT count(*) FROM '{sf}/conversations.parquet'").fetchall()[0][0]
    by = {}
    for r in sorted(rows, key=lambda r: r.position):
        by.setdefault(r.conv_id, []).append(r.segment)
    assert all(legal(parse(v)) for v in by.values())


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (2, 1, "ASSISTANT", "x" * 100_000), (2, None, "user", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("block", F.lit("b")).withColumn("rid", F.lit(1)).withColumn("segment", F.lit(0))
    got = C.repair(df).collect()
    assert len(got) == 5 and [r.turn for r in sorted((r for r in got if r.conv_id == 2), key=lambda r: r.position)] == [None, 1]
    assert C.repair(df.filter("false")).count() == 0


@pytest.mark.parametrize("role", [*C.ROLES, None])
def test_matrices(role):
    m = C.matrix(role)
    assert all(min(c for c, _, _, to in C.options(s, role) if to == t) == m[s, t] for s in range(4) for t in range(4) if m[s, t] < C.FAR)


def test_positions_do_not_depend_on_partitions(spark):
    """Every conversation counts from 0, whether it lies in one block or is cut in many."""
    rows = [(c, t, ["user", "assistant"][t % 2], f"text {t}") for c in (1, 2, 3) for t in range(40 if c == 2 else 5)] + [(4, 1, "user", "same")] * 9
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in ("4", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            got = C.repair(df).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        by_conv = {}
        for r in got:
            by_conv.setdefault(r.conv_id, []).append((r.position, r.turn))
        for c, own in by_conv.items():
            assert [p for p, _ in sorted(own)] == list(range(len(own))), c
            assert [t for _, t in sorted(own)] == sorted(t for _, t in own)
        seen.append(sorted(map(tuple, got)))
    assert seen[0] == seen[1]
