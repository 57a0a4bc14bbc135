"""Chat formatting with minimum-cost role repair.

Legal conversations: an optional system turn, then user and assistant in turn, beginning
with the user.  For every turn dynamic programming over this automaton chooses to
append it, to merge it into the turn before, to relabel it, or to insert an empty turn
first, with the least total cost; the repaired sequence is rendered.

The transfer costs of a stretch of turns are a 4 x 4 matrix under (min, +), which is
associative: a conversation is cut into segments of `SEGMENT` rows, each segment gives
its matrix, and the states at the segment borders follow from the matrices, level by level.  So a
conversation of any length is repaired exactly without being in one task.  The place of a row in
its conversation is a distributed rank: equal rows are counted, ranges of rows are numbered
alone, and the rows of the ranges before are added.

Costs: append 0, merge 1, insertion 2, relabel 3; of equal costs, in this order.

Defined cases: null and unknown roles count as relabelled whatever they become; a null
text is empty; turns are ordered by number (null first), then role and text, so repeated rows
merge; rows without a conversation id are one conversation; a system turn alone gets
an empty user turn; the marker ``<|`` inside a text becomes ``< |``; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

ROLES = ["system", "user", "assistant"]
#: Other names of roles.
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = {START: {SYSTEM, USER}, SYSTEM: {USER}, USER: {ASSISTANT}, ASSISTANT: {USER}}
ENDS = (USER, ASSISTANT)
MERGE, INSERT, RELABEL = 1, 2, 3
FAR = 1 << 40
SEGMENT, LEVEL = 256, 256


def step(state: int, role: int) -> tuple[int, int | None, bool]:
    """Cheapest way from a state to a turn of a role: cost, inserted role, merged."""
    ways = []
    if role in LEGAL[state]:
        ways.append((0, None, False))
    if state == role:
        ways.append((MERGE, None, True))
    ways += [(INSERT, x, False) for x in sorted(LEGAL[state]) if role in LEGAL[x]]
    return min(ways, key=lambda w: w[0]) if ways else (FAR, None, False)


STEPS = [[(FAR, None, False) if q == START else step(s, q) for q in range(4)] for s in range(4)]


def matrix(role: int) -> np.ndarray:
    """Costs from state to state of one turn; role START stands for an unknown one."""
    m = np.array([[STEPS[s][q][0] + (RELABEL if q != role else 0) for q in range(4)] for s in range(4)], np.int64)
    return np.minimum(m, FAR)


MATRICES = [matrix(r) for r in range(4)]
#: At the end: nothing, or one inserted turn that reaches a legal end.
FINAL = np.array([0 if s in ENDS else INSERT if s == SYSTEM else FAR for s in range(4)], np.int64)


def product(matrices: list[np.ndarray]) -> np.ndarray:
    out = np.where(np.eye(4, dtype=bool), 0, FAR)
    for m in matrices:
        out = np.minimum((out[:, :, None] + m[None, :, :]).min(axis=1), FAR)
    return out


def path(matrices: list[np.ndarray], enter: int, leave: int | None) -> list[int]:
    """States after each stretch of a cheapest way from `enter` to `leave` (None: any legal end)."""
    costs = [np.where(np.arange(4) == enter, 0, FAR)]
    for m in matrices:
        costs.append(np.minimum((costs[-1][:, None] + m).min(axis=0), FAR))
    state = int(np.argmin(costs[-1] + FINAL)) if leave is None else leave
    states = [state]
    for m, before in zip(reversed(matrices), reversed(costs[:-1])):
        states.append(int(np.argmin(before + m[:, states[-1]])))
    return states[-2::-1] if matrices else []


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, segment, turn, role number and name, text, and how many such rows the segment has; at most SEGMENT rows in all."""
    name = F.lower(F.trim(F.col("role")))
    for other, role in ALIASES.items():
        name = F.when(name == other, role).otherwise(name)
    number = F.coalesce(*(F.when(name == r, i + 1) for i, r in enumerate(ROLES)), F.lit(START))
    rows = turns.select("conv_id", "turn", number.alias("number"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    # the driver sees a sample of the keys, so they are short; stored, as ranges may differ when a task runs again
    ranges = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(counted.repartitionByRange(ranges, "conv_id", "turn", "role", F.substring("text", 1, 256)).withColumn("range", F.spark_partition_id()), "chat-ranges")
    totals = ranged.groupBy("conv_id", "range").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("conv_id").alias("k"), F.col("range").alias("r"), F.sum("n").over(earlier).alias("offset")).where("offset is not null")
    within = Window.partitionBy("range", "conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
    # a range begins inside one conversation at most: no more offsets than ranges
    placed = placed.join(F.broadcast(offsets), F.col("conv_id").eqNullSafe(F.col("k")) & (F.col("range") == F.col("r")), "left")
    placed = placed.withColumn("start", F.col("before") + F.coalesce("offset", F.lit(0)))
    full = placed.withColumn("segment", F.explode(F.sequence(F.floor(F.col("start") / SEGMENT), F.floor((F.col("start") + F.col("n") - 1) / SEGMENT))))
    copies = F.least(F.col("start") + F.col("n"), (F.col("segment") + 1) * SEGMENT) - F.greatest(F.col("start"), F.col("segment") * SEGMENT)
    return full.select("conv_id", "segment", "turn", "number", "role", "text", copies.alias("copies"))


def in_order(table: pa.Table) -> pa.Table:
    table = table.take(pa.array(np.repeat(np.arange(table.num_rows), table["copies"].to_numpy())))
    return table.sort_by([("turn", "ascending"), ("role", "ascending"), ("text", "ascending")]) if table.column("turn").null_count == 0 else table.take(pa.array(sorted(range(table.num_rows), key=lambda i: (table["turn"][i].is_valid, table["turn"][i].as_py() or 0, table["role"][i].as_py(), table["text"][i].as_py()))))


def borders(mats: DataFrame, key: str = "conv_id") -> DataFrame:
    """(conv_id, segment, enter, leave) from (conv_id, segment, costs): states at the borders of segments."""
    mats = stored(mats, "chat-matrices")
    most = mats.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    kind = mats.schema[key].dataType.simpleString()
    out = f"{key} {kind}, segment long, enter int, leave int"

    def of(table: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
        table = table.sort_by("segment")
        return table, [np.array(c, np.int64).reshape(4, 4) for c in table["costs"].to_pylist()]

    def states(table: pa.Table, enter: int, leave: int | None) -> pa.Table:
        table, parts = of(table)
        after = path(parts, enter, leave)
        return pa.table({key: table[key], "segment": table["segment"], "enter": pa.array([enter, *after[:-1]], pa.int32()), "leave": pa.array(after, pa.int32())})

    if most <= 4 * LEVEL:
        return mats.groupBy(key).applyInArrow(lambda t: states(t, START, None), out)
    mats = mats.withColumn("above", F.floor(F.col("segment") / LEVEL))

    def combine(table: pa.Table) -> pa.Table:
        table, parts = of(table)
        return pa.table({key: table[key][:1], "segment": table["above"][:1], "costs": pa.array([product(parts).ravel().tolist()], pa.list_(pa.int64()))})

    above = borders(mats.groupBy(key, "above").applyInArrow(combine, f"{key} {kind}, segment long, costs array<long>"), key)
    above = above.select(F.col(key).alias("k"), F.col("segment").alias("a"), F.col("enter").alias("first"), F.col("leave").alias("final"))
    known = mats.join(above, F.col(key).eqNullSafe(F.col("k")) & (F.col("above") == F.col("a")))
    return known.groupBy(key, "above").applyInArrow(lambda t: states(t, t["first"][0].as_py(), t["final"][0].as_py()), out)


def render(turns: list[tuple[int, str]], enter: int, states: list[int]) -> tuple[str, int, int, int, int]:
    """Text of a segment and its numbers of merges, relabels, insertions and its cost."""
    parts, merges, relabels, inserts, before = [], 0, 0, 0, enter

    def head(role: int, state: int) -> str:
        return ("<|end|>\n" if state != START else "") + f"<|{ROLES[role - 1]}|>\n"

    for (role, text), state in zip(turns, states):
        _, extra, merged = STEPS[before][state]
        text = text.replace("<|", "< |")
        relabels += role != state
        if merged:
            merges += 1
            parts.append("\n" + text)
        else:
            if extra is not None:
                inserts += 1
                parts.append(head(extra, before))
                before = extra
            parts.append(head(state, before) + text)
        before = state
    return "".join(parts), merges, relabels, inserts, MERGE * merges + RELABEL * relabels + INSERT * inserts


def repaired(turns: DataFrame) -> DataFrame:
    """One row per conversation and segment: conv_id, segment, rendered, n_turns, merges, relabels, inserts, cost.

    The texts of a conversation's segments, put together in order, are the conversation.
    """
    rows = numbered(turns)
    kind = rows.schema["conv_id"].dataType.simpleString()

    def costs(table: pa.Table) -> pa.Table:
        m = product([MATRICES[r] for r in in_order(table)["number"].to_pylist()])
        return pa.table({"conv_id": table["conv_id"][:1], "segment": table["segment"][:1], "costs": pa.array([m.ravel().tolist()], pa.list_(pa.int64()))})

    mats = rows.groupBy("conv_id", "segment").applyInArrow(costs, f"conv_id {kind}, segment long, costs array<long>")
    at = stored(borders(mats), "chat-borders")
    last = at.groupBy("conv_id").agg(F.max("segment").alias("final")).withColumnRenamed("conv_id", "c")
    at = at.join(last, F.col("conv_id").eqNullSafe(F.col("c"))).select(F.col("conv_id").alias("k"), F.col("segment").alias("s"), "enter", "leave", (F.col("segment") == F.col("final")).alias("ends"))

    def write(table: pa.Table) -> pa.Table:
        table = in_order(table)
        enter, leave, ends = (table[c][0].as_py() for c in ("enter", "leave", "ends"))
        roles = table["number"].to_pylist()
        states = path([MATRICES[r] for r in roles], enter, leave)
        text, merges, relabels, inserts, cost = render(list(zip(roles, table["text"].to_pylist())), enter, states)
        if ends and leave not in ENDS:
            text, inserts, cost = text + "<|end|>\n<|user|>\n", inserts + 1, cost + INSERT
        numbers = {"n_turns": table.num_rows, "merges": merges, "relabels": relabels, "inserts": inserts, "cost": cost}
        return pa.table({"conv_id": table["conv_id"][:1], "segment": table["segment"][:1], "rendered": [text + ("<|end|>\n" if ends else "")], **{k: pa.array([v], pa.int64()) for k, v in numbers.items()}})

    full = rows.join(at, F.col("conv_id").eqNullSafe(F.col("k")) & (F.col("segment") == F.col("s")))
    return full.groupBy("conv_id", "segment").applyInArrow(write, f"conv_id {kind}, segment long, rendered string, n_turns long, merges long, relabels long, inserts long, cost long")
