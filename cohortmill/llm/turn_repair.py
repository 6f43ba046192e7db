"""Repair of conversations by Hirschberg's divide and conquer over four states.

A conversation is right if its roles' initials read `(s?(ua)+)?`: nothing, or a system turn
that may be missing and then user and assistant in turn. Four states tell how far a reading
is: at the beginning, after the system turn, after a user, after an assistant. A
turn is kept (cost 0), given the role that the state asks for (Rerole, 1) or deleted (2), and turns without text
can be inserted anywhere (5). A blank turn and one whose role and text came earlier must go; a truncated
turn that stays costs 5 more. Of the cheapest ways the one with the ASCII-least audit (the
initials of its edits in order) is taken.

Costs and order of audits of a run of turns are a 4 x 4 table: the least cost from each state to
each, and how the least audits of one start compare. Two tables make that of both runs, so a turn, a block of turns
and a run of blocks are the same kind of thing. To find the edits, the forward vector of the first half
and the backward vector of the second meet in the middle: the crossing with the least sum, of equal ones
that with the least audit, parts the problem in two. No matrix of a whole conversation is kept.

Turns are put in order by a range sort, so a long conversation lies in many tasks; blocks of at
most 2 ** BITS of its turns make tables, up to 2 ** BITS tables make the next, until each conversation has one; the states then
go down the same way, and each block finds its own edits. Inserts stand before the turn that
they precede, those at the end behind the last turn.

Defined cases: conversations are told apart by id, a null one is a conversation of its own. Turns come by
number, null first; those of one number by role, then text, so repeated rows are next to each other and
input order never matters. Null role and text count as one space. A conversation without turns has a row if its id is given apart: zeros, an empty audit.
Columns that the operator doesn't name are ignored. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.common import small_batches, stored

BITS = 12
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5
NEVER = 1 << 40  # the cost of what can't be done
# Of each state: the state after the role it asks for, and that role.
NEXT = (2, 2, 3, 2)
ASKED = ("user", "user", "assistant", "user")
STATES = range(4)
BEGIN, SYSTEM = 0, 1
SPACE = " \t\n\x0b\f\r"
FINE, CUT_OFF, MUST_GO = range(3)

Vector = tuple[tuple[int, int], ...]  # cost and order of the audit, by state


def _moves(initial: str, fate: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of what can be done with a turn."""
    yield "D", COSTS["D"], state
    if fate != MUST_GO:
        more = TRUNCATED_COST if fate == CUT_OFF else 0
        yield "R", COSTS["R"] + more, NEXT[state]
        if initial == "s" and state == BEGIN:
            yield "K", COSTS["K"] + more, SYSTEM
        if initial == ASKED[state][0]:
            yield "K", COSTS["K"] + more, NEXT[state]


@cache
def turn_table(kind: str) -> tuple:
    """Cost and least audit of a turn from each state to each; a kind is an initial and a fate."""
    table = [[(NEVER, "")] * 4 for _ in STATES]
    for start in STATES:
        state = start
        for inserts in STATES:
            for letter, cost, end in _moves(kind[0], int(kind[1]), state):
                way = cost + inserts * COSTS["I"], "I" * inserts + letter
                table[start][end] = min(table[start][end], way)
            state = NEXT[state]
    return tuple(map(tuple, table))


# What it costs to end in each state, with the inserts that make it an end.
ENDS = tuple((COSTS["I"] * n, "I" * n) for n in (0, 2, 1, 0))


def _kind(initial: str, fate: int) -> str:
    return (initial if initial in ("s", "u", "a") else "-") + str(fate)


def start_at(state: int) -> Vector:
    return tuple((0, 0) if s == state else (NEVER, 0) for s in STATES)


def forward(vector: Vector, table: tuple) -> Vector:
    """The vector after a further table; its orders are 0 to 3."""
    best = []
    for end in STATES:
        best.append(min((vector[s][0] + table[s][end][0], (vector[s][1], table[s][end][1])) for s in STATES))
    order = {audit: i for i, audit in enumerate(sorted({audit for cost, audit in best if cost < NEVER}))}
    return tuple((cost, order[audit]) if cost < NEVER else (NEVER, 0) for cost, audit in best)


def backward(costs: tuple[int, ...], table: tuple) -> tuple[int, ...]:
    """The least cost to the end from each state before a table."""
    return tuple(min(min(table[s][e][0] + costs[e] for e in STATES), NEVER) for s in STATES)


@cache
def _forward_turn(vector: Vector, kind: str) -> tuple[Vector, int]:
    """`forward` by one turn, with the least cost taken off; few vectors remain."""
    after = forward(vector, turn_table(kind))
    least = min(cost for cost, _ in after)
    return tuple((cost - least if cost < NEVER else NEVER, order) for cost, order in after), least


@cache
def _backward_turn(costs: tuple[int, ...], kind: str) -> tuple[tuple[int, ...], int]:
    after = backward(costs, turn_table(kind))
    least = min(after)
    return tuple(cost - least if cost < NEVER else NEVER for cost in after), least


class Turns:
    """A run of turns, for `crossings`."""

    def __init__(self, kinds: list[str]):
        self.kinds = kinds

    def __len__(self) -> int:
        return len(self.kinds)

    def after(self, vector: Vector, lo: int, hi: int) -> Vector:
        total = 0
        for kind in self.kinds[lo:hi]:
            vector, least = _forward_turn(vector, kind)
            total += least
        return tuple((cost + total if cost < NEVER else NEVER, order) for cost, order in vector)

    def before(self, costs: tuple[int, ...], lo: int, hi: int) -> tuple[int, ...]:
        total = 0
        for kind in reversed(self.kinds[lo:hi]):
            costs, least = _backward_turn(costs, kind)
            total += least
        return tuple(cost + total if cost < NEVER else NEVER for cost in costs)


class Tables(Turns):
    """A run of tables, for `crossings`."""

    def after(self, vector: Vector, lo: int, hi: int) -> Vector:
        for table in self.kinds[lo:hi]:
            vector = forward(vector, table)
        return vector

    def before(self, costs: tuple[int, ...], lo: int, hi: int) -> tuple[int, ...]:
        for table in reversed(self.kinds[lo:hi]):
            costs = backward(costs, table)
        return costs


def table_of(run: Turns) -> tuple:
    return tuple(run.after(start_at(s), 0, len(run)) for s in STATES)


def crossings(run: Turns, start: int, end: int) -> list[int]:
    """The states at all borders of a run on its least way from one state to another."""
    states = [start] + [-1] * (len(run) - 1) + [end]
    open_runs = [(0, len(run))]
    while open_runs:
        lo, hi = open_runs.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        first = run.after(start_at(states[lo]), lo, mid)
        second = run.before(tuple(0 if s == states[hi] else NEVER for s in STATES), mid, hi)
        states[mid] = min(STATES, key=lambda s: (first[s][0] + second[s], first[s][1]))
        open_runs += [(lo, mid), (mid, hi)]
    return states


def last_state(vector: Vector) -> int:
    """The state in which the least way of a whole conversation ends."""
    return min(STATES, key=lambda s: (vector[s][0] + ENDS[s][0], vector[s][1]))


def edits_of(kinds: list[str], states: list[int]) -> list[str]:
    return [turn_table(k)[s][e][1] for k, s, e in zip(kinds, states, states[1:])]


def repaired_audit(kinds: list[str]) -> tuple[int, list[str]]:
    """Cost and edits of a whole conversation held in memory; the last entry are inserts at the end."""
    run = Turns(kinds)
    vector = run.after(start_at(BEGIN), 0, len(run))
    end = last_state(vector)
    states = crossings(run, BEGIN, end) if kinds else [BEGIN]
    return vector[end][0] + ENDS[end][0], edits_of(kinds, states) + [ENDS[end][1]]


# ---- on Spark


def ordered(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The turns in order, stored: `ord` grows with (conv_id, turn, role, text)."""
    rows = conversations.select(
        F.col(conv_id).cast("bigint").alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    key = ["conv_id", "turn", "role", "text"]
    inside = rows.repartitionByRange(*key).sortWithinPartitions(*key)
    return stored(inside.withColumn("ord", F.monotonically_increasing_id()), "turns-in-order")


def faults(turns: DataFrame) -> DataFrame:
    """(conv_id, ord, turn, initial, fault) of ordered turns; fault is null or the first that counts."""
    # A length before the role keeps role and text apart in the digest.
    key = F.sha2(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"), 256)
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    rows = turns.select(
        "conv_id", "ord", "turn", F.left("role", F.lit(1)).alias("initial"), key.alias("same"), last.alias("last")
    )
    # One row for each first turn of its kind, however often the others repeat it.
    firsts = rows.groupBy("conv_id", "same").agg(F.min("ord").alias("ord")).select("ord", F.lit(True).alias("first"))
    fault = (
        F.when(F.col("last") == "", "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(~F.col("last").isin(".", "!", "?"), "truncated")
    )
    return rows.join(firsts, "ord", "left").select("conv_id", "ord", "turn", "initial", fault.alias("fault"))


_NODE = (
    "conv_id bigint, first_ord bigint, costs array<bigint>, orders array<bigint>, "
    "opening string, closing string, illegal bigint"
)
LEGAL = {"su", "ua", "au"}


def _names(schema: str) -> list[str]:
    return [field.split(" ")[0] for field in schema.split(", ")]


def _flat(table: tuple) -> tuple[list[int], list[int]]:
    return [cost for row in table for cost, _ in row], [order for row in table for _, order in row]


def _nested(costs: list[int], orders: list[int]) -> tuple:
    return tuple(tuple(zip(costs[i : i + 4], orders[i : i + 4])) for i in range(0, 16, 4))


def _illegal(pairs) -> int:
    return sum(a + b not in LEGAL for a, b in pairs)


def _by_row(work, schema: str):
    """`work` on each row as a dict; it gives tuples."""
    names = _names(schema)
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    types = [kinds[field.split(" ")[1]] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [out for row in batch.to_pylist() for out in work(row)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def blocks(marked: DataFrame, bits: int = BITS) -> DataFrame:
    """(conv_id, first_ord, kinds, initials) of at most 2 ** bits turns each, stored."""
    fate = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", CUT_OFF).otherwise(FINE)
    turn = F.struct("ord", "initial", fate.alias("fate"))
    held = marked.groupBy("conv_id", F.shiftright("ord", bits).alias("block")).agg(
        F.min("ord").alias("first_ord"), F.array_sort(F.collect_list(turn)).alias("turns")
    )
    return stored(held.drop("block"), "turn-blocks")


def _kinds(turns: list[dict]) -> list[str]:
    return [_kind(t["initial"], t["fate"]) for t in turns]


def _block_node(row: dict):
    turns = row["turns"]
    initials = [t["initial"] for t in turns]
    yield (
        row["conv_id"], row["first_ord"], *_flat(table_of(Turns(_kinds(turns)))), initials[0], initials[-1],
        _illegal(zip(initials, initials[1:])),
    )


def _tables(children: list[dict]) -> Tables:
    return Tables([_nested(c["costs"], c["orders"]) for c in children])


def _border_illegal(children: list[dict]) -> int:
    return sum(c["illegal"] for c in children) + _illegal(
        (a["closing"], b["opening"]) for a, b in zip(children, children[1:])
    )


def _parent_node(row: dict):
    children = row["children"]
    yield (
        row["conv_id"], children[0]["first_ord"], *_flat(table_of(_tables(children))), children[0]["opening"],
        children[-1]["closing"], _border_illegal(children),
    )


def _grouped(nodes: DataFrame, *keys) -> DataFrame:
    columns = [name for name in _names(_NODE) if name != "conv_id"]
    children = F.array_sort(F.collect_list(F.struct(*columns))).alias("children")
    return nodes.groupBy("conv_id", *keys).agg(F.min("first_ord").alias("first_ord"), children)


_WAYS = "first_ord bigint, start bigint, stop bigint, tail string"
_ROOTS = "conv_id bigint, cost bigint, illegal bigint, children array<bigint>, states array<bigint>, tail string"


def _root(row: dict):
    children = row["children"]
    run = _tables(children)
    vector = run.after(start_at(BEGIN), 0, len(run))
    end = last_state(vector)
    yield (
        row["conv_id"], vector[end][0] + ENDS[end][0], _border_illegal(children), [c["first_ord"] for c in children],
        crossings(run, BEGIN, end), ENDS[end][1],
    )


def _ways(row: dict):
    """Start and end state of each child; what stands behind the last turn goes with the last child."""
    children, states = row["children"], row["states"]
    for i, (first, start, stop) in enumerate(zip(children, states, states[1:])):
        yield first, start, stop, row["tail"] if i == len(children) - 1 else ""


def _parent_ways(row: dict):
    states = crossings(_tables(row["children"]), row["start"], row["stop"])
    return _ways({"children": [c["first_ord"] for c in row["children"]], "states": states, "tail": row["tail"]})


EDITS = "conv_id bigint, first_ord bigint, start bigint, edits array<string>"


def _block_edits(row: dict):
    kinds = _kinds(row["turns"])
    edits = edits_of(kinds, crossings(Turns(kinds), row["start"], row["stop"]))
    yield row["conv_id"], row["first_ord"], row["start"], [*edits, row["tail"]]


def solve(marked: DataFrame, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(conv_id, cost, illegal) of conversations, and the edits of each block: those
    of its turns in order, then inserts behind the last."""
    small_batches(marked.sparkSession)
    held = blocks(marked, bits)
    nodes = stored(held.mapInArrow(_by_row(_block_node, _NODE), _NODE), "turn-nodes")
    levels, shift = [], bits
    while (nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0) > 1 << bits:
        shift = min(shift + bits, 63)
        levels.append(stored(_grouped(nodes, F.shiftright("first_ord", shift)), "turn-levels"))
        nodes = stored(levels[-1].mapInArrow(_by_row(_parent_node, _NODE), _NODE), "turn-nodes")
    roots = stored(_grouped(nodes).mapInArrow(_by_row(_root, _ROOTS), _ROOTS), "turn-roots")
    ways = roots.mapInArrow(_by_row(_ways, _WAYS), _WAYS)
    for level in reversed(levels):
        ways = level.select("first_ord", "children").join(ways, "first_ord").mapInArrow(_by_row(_parent_ways, _WAYS), _WAYS)
    edits = held.join(ways, "first_ord").mapInArrow(_by_row(_block_edits, EDITS), EDITS)
    return roots.select("conv_id", "cost", "illegal"), stored(edits, "turn-edits")


REPAIRED = "conv_id bigint, ord bigint, step int, edit string, role string, text string"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired turns, from turns in order and, before those of each block, its edits."""
    edits, at, state = [], 0, BEGIN
    types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
    for batch in batches:
        out = []
        for conv, place, given, start, role, text in zip(
            *(batch[c].to_pylist() for c in ("conv_id", "ord", "edits", "start", "role", "text"))
        ):
            if given is not None:
                edits, at, state = given, 0, start
                continue
            letters, at = edits[at], at + 1
            if at == len(edits) - 1:
                letters += edits[at]
            for step, letter in enumerate(letters):
                if letter == "D":
                    continue
                if letter == "K":
                    out.append((conv, place, step, letter, role, text))
                    state = SYSTEM if role[:1] == "s" else NEXT[state]
                else:
                    out.append((conv, place, step, letter, ASKED[state], text if letter == "R" else ""))
                    state = NEXT[state]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=_names(REPAIRED))


def repaired(turns: DataFrame, edits: DataFrame, whole: bool = False, bits: int = BITS) -> DataFrame:
    """The repaired turns, ordered by (ord, step) within a conversation.

    Blocks are dealt to tasks; with `whole`, conversations are, and each task has its own in order.
    """
    small_batches(turns.sparkSession)
    columns = ("conv_id", "ord", "rank", "edits", "start", "role", "text")
    heads = edits.select(
        "conv_id", F.col("first_ord").alias("ord"), F.lit(0).alias("rank"), "edits", "start",
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
    )
    rows = turns.select(
        "conv_id", "ord", F.lit(1).alias("rank"), F.lit(None).cast("array<string>").alias("edits"),
        F.lit(None).cast("bigint").alias("start"), "role", "text",
    )
    both = heads.select(*columns).unionByName(rows.select(*columns))
    dealt = both.repartition("conv_id") if whole else both.repartition("conv_id", F.shiftright("ord", bits))
    return dealt.sortWithinPartitions("conv_id", "ord", "rank").drop("rank").mapInArrow(_walk, REPAIRED)


DIGESTS = "conv_id bigint, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, types = _names(DIGESTS), [pa.int64(), pa.string()]
    own, digest, begun = None, hashlib.sha256(), False
    for batch in batches:
        done = []
        for conv, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text"))):
            if begun and conv == own:
                digest.update(b"\n")
            else:
                if begun:
                    done.append((own, digest.hexdigest()))
                own, digest, begun = conv, hashlib.sha256(), True
            digest.update(f"{role}:{text}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
    if begun:
        yield pa.RecordBatch.from_arrays([pa.array([own], types[0]), pa.array([digest.hexdigest()])], names=names)


SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def summary(conversations: DataFrame, ids: DataFrame | None = None, bits: int = BITS, **names) -> DataFrame:
    """A row for each conversation: counts of faults, cost, audit, digest of the repaired turns.

    Conversations of `ids` (conv_id) have a row even if they have no turns. The digest reads a conversation's turns one after the other, in one task but never all at once.
    """
    turns = ordered(conversations, **names)
    marked = stored(faults(turns), "turn-faults")
    roots, edits = solve(marked, bits)
    counted = [F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")]
    counts = marked.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"), *counted
    )
    of_block = F.struct("first_ord", F.array_join("edits", "").alias("audit"))
    audits = edits.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(of_block)), lambda b: b["audit"]), "").alias("audit")
    )
    digests = repaired(turns, edits, whole=True, bits=bits).select("conv_id", "role", "text").mapInArrow(_digests, DIGESTS)
    # Ids may be null: put together by grouping, which takes null as a value.
    parts = counts
    for part in (roots, audits, digests, *([] if ids is None else [ids.select("conv_id").distinct()])):
        parts = parts.unionByName(part, allowMissingColumns=True)
    got = parts.groupBy("conv_id").agg(*[F.max(name).alias(name) for name in SUMMARY])
    return got.select("conv_id", *[F.coalesce(name, F.lit(0)).alias(name) for name in SUMMARY[:6]],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
