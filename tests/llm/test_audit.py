import random
from fractions import Fraction
from itertools import permutations

from canopy.llm import audit as A

LABELS = "doc_id long, quality int, toxic int"
DOCS = "doc_id long, text string, source string, part string, n string"


def plain_shapley(v, n):
    """The mean marginal value over all orders."""
    out = [Fraction(0)] * n
    orders = list(permutations(range(n)))
    for order in orders:
        s = 0
        for i in order:
            out[i] += Fraction(v[s | 1 << i] - v[s], len(orders))
            s |= 1 << i
    return out


def test_shapley_of_any_game():
    rng = random.Random(1)
    for n in (2, 3, 4, 5):
        for _ in range(20):
            v = [rng.randrange(-50, 50) for _ in range(2**n)]
            assert A.shapley(v) == plain_shapley(v, n)


def test_removals():
    assert A.removals({0: 5, 1: 2, 3: 4}, 2) == [0, 6, 4, 6]
    assert A.interactions({0b00011: 4, 0b10001: 1, 0b00001: 9})[("A", "B")] == 4


def fails(rows):
    """The failed filters of every row, by their definitions."""
    out = []
    for i, text, *_ in rows:
        text = text or ""
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        f = set()
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
            f.add("C")
        if any(c in "#$%&*|" for c in text):
            f.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows):
            f.add("E")
        out.append(f)
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out, total = {}, {}
    failed = fails(rows)
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, failed, strict=True) if (r[2] or "") == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [(i, f) for i, f in left if c in f]
                left = [(i, f) for i, f in left if c not in f]
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(c in f for _, f in mine) - len(gone), sum(f == {c} for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
                total[part, c] = total.get((part, c), 0) + len(gone)
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def make(rng):
    prose = [" ".join(f"w{i}" for i in range(n)) for n in (150, 250, 300)]
    texts = prose + ["x " * 250, "A " * 300, "#" + prose[1], None, "", "é" * 10, "AB " * 3 + prose[2], "\x0b".join(f"Ñ{i}" for i in range(220))]
    ids = [*range(20), None]
    rows = [(rng.choice(ids), rng.choice(texts), rng.choice(["a", "b", None, ""]), "clash", "clash") for _ in range(120)]
    labels = [(rng.choice(ids), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(25)]
    return rows, labels


def test_against_orders_applied(spark):
    """Nulls, ties, repeated rows and ids, several label rows of one id, clashing names."""
    for seed in (1, 2):
        rows, labels = make(random.Random(seed))
        got = A.audit(spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame(labels, LABELS)).collect()
        assert {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got} == plain_audit(rows, labels)
        assert len(got) == 600 * 3


def test_odd_rows(spark, odd_docs, empty_docs):
    labels = spark.createDataFrame([], LABELS)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]
    got = A.audit(odd_docs, labels).collect()
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got} == plain_audit(rows, [])
    assert A.audit(empty_docs, labels).collect() == []
