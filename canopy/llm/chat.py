"""Minimum-cost role repair of conversations (op 9).

A legal conversation is an optional system turn, then user and assistant in turn, ending with the
assistant. Each turn of a conversation is taken as is, relabelled, merged into the turn before, or
preceded by an empty turn; the sum of the costs is least. Among equal sums the first in the order
append, merge, insert, and system, user, assistant wins, turn by turn from the front, so the result
is one and does not depend on partitions.

Dynamic programming over the automaton's four states is a product of 4 x 4 matrices in the
(min, +) algebra, which is associative. So a conversation may be cut: rows are sorted by range over
the whole table, each range partition is a block, and only conversations that span blocks (at most
one per boundary) take part in two small passes: block matrices give the cost to go at each block's
end, then each block's exit state for every entry state gives the states at the cuts. The last pass
renders every block. No conversation, however long, is gathered in one task.

Each row renders to a segment; the conversation is the segments joined in order. Null role or one
the automaton does not know must be relabelled. Null or empty text is an empty turn. Rows are
ordered by turn (null first), then role and text; repeated rows are turns of their own. Rows with
null conv_id form one conversation. An empty table gives no rows. Only conv_id, turn, role and text
are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, ship, written

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
#: States from which a role may open a new turn.
LEGAL = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
MERGE, RELABEL, INSERT = 2, 3, 4
FAR = 1 << 50
#: Empty turns that end a conversation from each state.
ENDS = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
AT_END = [INSERT * len(ENDS[s]) for s in range(4)]


@cache
def options(state: int, role: str | None) -> tuple[tuple[int, str, tuple[int, ...], int], ...]:
    """(cost, action, empty turns before, new state) of a turn, in order of preference."""
    out = []
    for action in ("append", "merge", "insert"):
        for x in (SYSTEM, USER, ASSISTANT):
            cost = 0 if role == ROLES[x - 1] else RELABEL
            if action == "append" and state in LEGAL[x]:
                out.append((cost, action, (), x))
            elif action == "merge" and state == x:
                out.append((cost + MERGE, action, (), x))
            elif action == "insert":
                out += [(cost + INSERT, action, (e,), x) for e in (SYSTEM, USER, ASSISTANT) if state in LEGAL[e] and e in LEGAL[x]]
    return tuple(out)


@cache
def matrix(role: str | None) -> np.ndarray:
    m = np.full((4, 4), FAR, np.int64)
    for s in range(4):
        for cost, _, _, to in options(s, role):
            m[s, to] = min(m[s, to], cost)
    return m


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (min, +) product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def costs_to_go(roles: list[str | None], end: list[int]) -> list[list[int]]:
    """The least cost from each state before each turn to the end, whose costs are `end`."""
    out = [end]
    for role in reversed(roles):
        after = out[-1]
        out.append([min((c + after[to] for c, _, _, to in options(s, role)), default=FAR) for s in range(4)])
    return out[::-1]


def choose(state: int, role: str | None, after: list[int]) -> tuple[int, str, tuple[int, ...], int]:
    return min(options(state, role), key=lambda o: o[0] + after[o[3]])


def walk(roles: list[str | None], entry: int, end: list[int]) -> Iterator[tuple[int, str, tuple[int, ...], int]]:
    """The chosen option of each turn."""
    state = entry
    for role, after in zip(roles, costs_to_go(roles, end)[1:], strict=True):
        best = choose(state, role, after)
        state = best[3]
        yield best


def opening(x: int) -> str:
    return f"<|{ROLES[x - 1]}|>\n"


def _known(role: str | None) -> str | None:
    return role if role in ROLES else None


def _blocks(rows: DataFrame, cols: list[str]) -> DataFrame:
    """Rows dealt by (conversation, block) and sorted, for one pass over each."""
    return (rows.select("conv_id", "block", "rid", *cols).repartition("conv_id", "block")
            .sortWithinPartitions("conv_id", "block", "rid").select("conv_id", "block", "rid", *cols))


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, position (from 0 in its conversation's order), role_in, role_out,
    action, inserted (empty turns around it), cost, segment."""
    spark = conversations.sparkSession
    ship(spark)
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    # the turn's text is part of the range key, so even one repeated turn can be cut
    rows = (conversations.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("h"))
            .repartitionByRange(keys[0], keys[1], keys[2], F.col("h")).sortWithinPartitions(*keys)
            .withColumn("rid", F.monotonically_increasing_id()).withColumn("block", F.spark_partition_id()).drop("h"))
    rows = written(rows, "turns")
    # a block boundary cuts one conversation at most, so this table has fewer rows than there are blocks
    many = written(rows.groupBy("conv_id").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).filter("lo < hi"), "cut")
    cut = rows.alias("r").join(many.alias("m"), F.col("r.conv_id").eqNullSafe(F.col("m.conv_id"))).select("r.*")

    def products(it: Iterator[tuple]) -> Iterator[tuple]:
        for (conv, block), group in itertools.groupby(it, key=lambda r: r[:2]):
            m = np.where(np.eye(4, dtype=bool), 0, FAR)
            for r in group:
                m = times(m, matrix(_known(r[3])))
            yield conv, block, m.ravel().tolist()

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block", ascending=False)
        togo, out = np.array(AT_END), []
        for m in pdf["m"]:
            out.append(togo.tolist())
            togo = np.minimum((np.array(m).reshape(4, 4) + togo[None, :]).min(axis=1), FAR)
        return pdf[["conv_id", "block"]].assign(togo=out)

    def exits(it: Iterator[tuple]) -> Iterator[tuple]:
        for (conv, block), group in itertools.groupby(it, key=lambda r: r[:2]):
            g = list(group)
            roles, states = [_known(r[3]) for r in g], []
            after = costs_to_go(roles, list(g[0][4]))[1:]
            for state in range(4):
                for role, a in zip(roles, after, strict=True):
                    state = choose(state, role, a)[3]
                states.append(state)
            yield conv, block, states, list(g[0][4]), len(g)

    def entries(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        state, out = START, []
        for x in pdf["exits"]:
            out.append(state)
            state = int(x[state])
        return pdf[["conv_id", "block", "togo"]].assign(entry=out, last=[False] * (len(pdf) - 1) + [True],
                                                       before=pdf["n"].cumsum() - pdf["n"])

    per_block = map_rows(_blocks(cut, ["role"]), products, "conv_id long, block int, m array<long>")
    togo = written(per_block.groupBy("conv_id").applyInPandas(ends, "conv_id long, block int, togo array<long>"), "togo")
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & (F.col(f"{a}.block") == F.col(f"{b}.block"))
    with_end = cut.alias("r").join(togo.alias("t"), same("r", "t")).select("r.*", "t.togo")
    out_states = map_rows(_blocks(with_end, ["role", "togo"]), exits, "conv_id long, block int, exits array<int>, togo array<long>, n long")
    known = written(out_states.groupBy("conv_id").applyInPandas(
        entries, "conv_id long, block int, togo array<long>, entry int, last boolean, before long"), "entries")

    def segments(it: Iterator[tuple]) -> Iterator[tuple]:
        for (conv, _), group in itertools.groupby(it, key=lambda r: r[:2]):
            g = list(group)
            entry, end, last, start = (g[0][5], list(g[0][6]), *g[0][7:9]) if g[0][5] is not None else (START, AT_END, True, 0)
            steps = list(walk([_known(r[4]) for r in g], entry, end))
            for k, ((_, _, _, turn, role, *_, text), (cost, action, before, x)) in enumerate(zip(g, steps, strict=True)):
                head = "".join(opening(e) + "\n" for e in before)
                body = ("\n" + (text or "") if action == "merge" else opening(x) + (text or ""))
                tail = ENDS[x] if last and k == len(g) - 1 else ()
                yield (conv, turn, start + k, role, ROLES[x - 1], action, len(before) + len(tail), cost + INSERT * len(tail),
                       head + body + "\n" + "".join(opening(e) + "\n" for e in tail))

    full = (rows.alias("r").join(known.alias("t"), same("r", "t"), "left")
            .select("r.*", "t.entry", "t.togo", "t.last", "t.before"))
    return map_rows(_blocks(full, ["turn", "role", "entry", "togo", "last", "before", "text"]), segments,
                    "conv_id long, turn long, position long, role_in string, role_out string, action string, "
                    "inserted int, cost int, segment string")
