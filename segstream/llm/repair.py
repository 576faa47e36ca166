"""Conversation structure repair by iterative-deepening A*.

A conversation is well formed if its roles' initials read ``(s?(ua)+)?``. The
cheapest edits that make it so are searched row by row: keep (0), rerole to the
role that fits (3), delete (4), insert an empty turn of the role that fits (3);
blank and repeated rows must go, and a truncated row that stays costs 3 more.

Search. Depth first in ASCII order of the edits' initials (D, I, K, R) under a
cost bound that starts at the heuristic and rises to the least cost that went
over it. The heuristic adds what each remaining row costs at least and what the
rest of the conversation costs at least. A table remembers, for each (row,
state), the largest budget that was not enough; it stays valid as the bound
rises. The first path accepted is the cheapest, and the ASCII-least of these.

Scale. Rows are sorted once by range over (conversation, turn, ...), so that a
conversation of any length is spread over tasks, and cut into chunks. Each
chunk tells, for each of the four states it can be entered in and left in, the
least cost (a min-plus product over its rows). A pass from the last chunk back
turns these into the cost still to come at each chunk's end, which makes the
searches of the chunks independent of each other; a forward pass strings the
chunks together and hashes the repaired rows as they come by. Only the costs
and the chosen edits of a conversation pass through one task, never its rows
at once. Inside a chunk the search takes ``PIECE`` rows at a time.

Defined results: null roles and texts count as one space, so such texts are
blank and such roles fit nothing; rows with equal turns are ordered by role,
then by the digest of their text; a null conv_id is a conversation; rows of a
conversation may repeat and are then duplicates; a conversation without rows
has no edits; an empty table gives an empty result; texts are taken whole; other
columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segstream.llm.common import settle, written

#: What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
CHUNK = 4096  #: rows that one search task takes of a partition at a time
PIECE = 64  #: rows that one search looks at
PARTITION = 1 << 33  #: how far apart monotonically increasing ids of two partitions lie
INF = 1 << 60
#: States: nothing yet, after s, after u, after a; what they take next and become by it.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
WANTED = ("user", "user", "assistant", "user")
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
KEPT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
#: What is inserted at the very end, and what it costs.
CLOSING = ("", "II", "I", "")
AT_END = tuple(INSERT * len(x) for x in CLOSING)
LEGAL = {"su", "ua", "au"}


class Row(NamedTuple):
    role: str
    text: str
    fault: str | None  #: blank, duplicate or truncated

    @property
    def must_go(self) -> bool:
        return self.fault in ("blank", "duplicate")

    @property
    def stay(self) -> int:
        return TRUNCATED if self.fault == "truncated" else 0

    @property
    def least(self) -> int:
        return DELETE if self.must_go else self.stay


# ------------------------------------------------------------- least costs


def before(row: Row, after: list[int]) -> list[int]:
    """Least cost from each state ahead of ``row``, given those behind it."""
    direct = []
    for s in STATES:
        best = DELETE + after[s]
        if not row.must_go:
            best = min(best, REROLE + row.stay + after[NEXT[s]])
            if (s, row.role[:1]) in KEPT:
                best = min(best, row.stay + after[KEPT[s, row.role[:1]]])
        direct.append(best)
    return inserted(direct)


def inserted(costs: list[int]) -> list[int]:
    """The same with up to two turns inserted first; a third repeats a state."""
    return [min(costs[s], INSERT + costs[NEXT[s]], 2 * INSERT + costs[NEXT[NEXT[s]]]) for s in STATES]


def cost_table(rows: list[Row]) -> list[int]:
    """Least cost from each state ahead of the rows to each behind them (4 x 4)."""
    columns = []
    for end in STATES:
        costs = [0 if s == end else INF for s in STATES]
        for row in reversed(rows):
            costs = before(row, costs)
        columns.append(costs)
    return [min(INF, columns[end][s]) for s in STATES for end in STATES]


def through(table: list[int], after: list[int]) -> list[int]:
    return [min(table[4 * s + end] + after[end] for end in STATES) for s in STATES]


# ------------------------------------------------------------------ search


def search(rows: list[Row], entry: int, after: list[int]) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits of ``rows`` from state ``entry``
    when leaving in state s costs ``after[s]``, and the state they leave in."""
    rest = min(after)
    ahead = [rest]
    for row in reversed(rows):
        ahead.append(ahead[-1] + row.least)
    ahead.reverse()
    failed: dict[tuple[int, int], int] = {}

    def moves(at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(edit, cost, row, state) in ASCII order."""
        row = rows[at] if at < len(rows) else None
        if row is not None:
            yield "D", DELETE, at + 1, state
            yield "I", INSERT, at, NEXT[state]
            if not row.must_go:
                if (state, row.role[:1]) in KEPT:
                    yield "K", row.stay, at + 1, KEPT[state, row.role[:1]]
                yield "R", REROLE + row.stay, at + 1, NEXT[state]

    bound = ahead[0]
    while True:
        over = INF
        path, spent = [], [0]
        stack = [(0, entry, moves(0, entry))]
        while stack:
            at, state, options = stack[-1]
            if at == len(rows):
                if spent[-1] + after[state] <= bound:
                    return "".join(path), state
                over = min(over, spent[-1] + after[state])
            step = next(options, None)
            if step is None:
                failed[at, state] = max(failed.get((at, state), -1), bound - spent[-1])
                stack.pop()
                spent.pop()
                if path:
                    path.pop()
                continue
            edit, cost, to, become = step
            total = spent[-1] + cost
            if total + ahead[to] > bound:
                over = min(over, total + ahead[to])
            elif failed.get((to, become), -1) < bound - total:
                stack.append((to, become, moves(to, become)))
                path.append(edit)
                spent.append(total)
            else:  # known not to do within this budget: one more is the least that might
                over = min(over, bound + 1)
        bound = over


def search_chunk(rows: list[Row], entry: int, after: list[int]) -> tuple[str, int]:
    """``search`` over any number of rows, PIECE of them at a time."""
    behind, costs = [], list(after)
    pieces = [rows[i : i + PIECE] for i in range(0, len(rows), PIECE)]
    for piece in reversed(pieces):
        behind.append(costs)
        for row in reversed(piece):
            costs = before(row, costs)
    audit, state = [], entry
    for piece, costs in zip(pieces, reversed(behind)):
        edits, state = search(piece, state, costs)
        audit.append(edits)
    return "".join(audit), state


def apply_edits(rows: list[Row], entry: int, audit: str) -> list[str]:
    """``role:text`` of the repaired rows."""
    out, state, at = [], entry, 0
    for edit in audit:
        row = rows[at] if edit != "I" else None
        if edit == "I":
            out.append(f"{WANTED[state]}:")
        elif edit == "K":
            out.append(f"{row.role}:{row.text}")
        elif edit == "R":
            out.append(f"{WANTED[state]}:{row.text}")
        if edit in "IR":
            state = NEXT[state]
        elif edit == "K":
            state = KEPT[state, row.role[:1]]
        at += edit != "I"
    return out


def spent_on(rows: list[Row], audit: str) -> int:
    cost, at = 0, 0
    for edit in audit:
        if edit == "I":
            cost += INSERT
            continue
        cost += DELETE if edit == "D" else rows[at].stay + (REROLE if edit == "R" else 0)
        at += 1
    return cost


# -------------------------------------------------------------------- Spark


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of ``conv_id:turn`` picks."""

    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    named = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    changed = named.where("kind <> 0").select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies))
    return changed.drop("col")


def in_order(rows: DataFrame) -> tuple[DataFrame, str]:
    """Rows written in (conversation, turn, role, text) order, with ``pos``
    rising in that order and ``chunk`` the pos that its chunk begins at; and their folder."""
    keyed = rows.withColumn("digest", F.md5(F.col("text").cast("binary"))).withColumn("salt", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "salt")]
    sorted_rows = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("salt")
    found, folder = written(sorted_rows.withColumn("pos", F.monotonically_increasing_id()), "turns")
    return found.withColumn("chunk", F.expr(f"pos - (pos % {PARTITION}L) % {CHUNK}")), folder


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``fault``: blank, duplicate (role and text seen earlier in the
    conversation), truncated or null."""
    key = ["conv_id", "role", "digest"]
    first = rows.groupBy(*key).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    first = first.select(*[F.col(c).alias(f"f_{c}") for c in key], "first")
    same = F.col("conv_id").eqNullSafe(F.col("f_conv_id")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
        .when(F.col("pos") > F.col("first"), "duplicate")
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")
    )
    return rows.join(first, same, "left").select("conv_id", "chunk", "pos", "role", "text", fault.alias("fault"))


def pieces_of(table: pa.Table) -> Iterator[tuple[object, list[Row]]]:
    """(conv_id, rows) of a chunk's conversations, in order."""
    rows = sorted(zip(*(table[c].to_pylist() for c in ("pos", "conv_id", "role", "text", "fault"))))
    for conv, part in groupby(rows, key=lambda r: r[1]):
        yield conv, [Row(*r[2:]) for r in part]


def by_conversation(rows: DataFrame, order: Column) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", order)


def cost_tables(rows: DataFrame, conv_type: str) -> DataFrame:
    """(conv_id, chunk, costs) of each conversation's part of each chunk."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        found = list(pieces_of(table.select(["pos", "conv_id", "role", "text", "fault"])))
        return pa.table(
            {
                "conv_id": pa.array([c for c, _ in found], table.schema.field("conv_id").type),
                "chunk": pa.array([key[0].as_py()] * len(found), pa.int64()),
                "costs": pa.array([cost_table(r) for _, r in found], pa.list_(pa.int64())),
            }
        )

    return rows.groupBy("chunk").applyInArrow(run, f"conv_id {conv_type}, chunk long, costs array<long>")


def costs_to_come(tables: DataFrame, conv_type: str) -> DataFrame:
    """(conv_id, chunk, first, after): the cost still to come behind each part,
    by state, and whether the conversation begins with it. Parts are read from
    the last one back; a part waits until the one before it is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_kind, waiting, last, costs = None, None, object(), list(AT_END)
        for batch in batches:
            conv_kind, out = batch.schema.field("conv_id").type, []
            for conv, chunk, table in zip(*(batch[c].to_pylist() for c in ("conv_id", "chunk", "costs"))):
                if waiting is not None:
                    out.append((*waiting[:2], conv != last, waiting[2]))
                if conv != last:
                    costs, last = list(AT_END), conv
                waiting = (conv, chunk, costs)
                costs = through(table, costs)
            if out:
                yield parts(out, conv_kind)
        if waiting is not None:
            yield parts([(*waiting[:2], True, waiting[2])], conv_kind)

    def parts(rows: list[tuple], conv_kind: pa.DataType) -> pa.RecordBatch:
        types = [conv_kind, pa.int64(), pa.bool_(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["conv_id", "chunk", "first", "after"])

    return by_conversation(tables, F.desc("chunk")).mapInArrow(run, f"conv_id {conv_type}, chunk long, first boolean, after array<long>")


FOUND = "chunk long, entry int, leave int, audit string, repaired string, cost long, blank long, duplicate long, truncated long, illegal long, head string, tail string"


def edits(rows: DataFrame, to_come: DataFrame, conv_type: str) -> DataFrame:
    """The edits of each part from each state that it can be entered in, with
    what they cost, the repaired rows and the part's faults. ``repaired`` is null
    where no row is left."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        ahead = {c: (first, after) for c, first, after in zip(*(right[x].to_pylist() for x in ("conv_id", "first", "after")))}
        out = []
        for conv, part in pieces_of(left):
            initials = [r.role[:1] for r in part]
            faults = [sum(r.fault == f for r in part) for f in ("blank", "duplicate", "truncated")]
            illegal = sum(x + y not in LEGAL for x, y in zip(initials, initials[1:]))
            first, after = ahead[conv]
            for entry in [START] if first else STATES:
                audit, leave = search_chunk(part, entry, after)
                lines = apply_edits(part, entry, audit)
                out.append((conv, key[0].as_py(), entry, leave, audit, "\n".join(lines) if lines else None, spent_on(part, audit), *faults, illegal, initials[0], initials[-1]))
        types = [left.schema.field("conv_id").type, pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string()] + [pa.int64()] * 5 + [pa.string()] * 2
        names = ["conv_id", *(x.split()[0] for x in FOUND.split(", "))]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return rows.groupBy("chunk").cogroup(to_come.groupBy("chunk")).applyInArrow(run, f"conv_id {conv_type}, {FOUND}")


WHOLE = "blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Whole:
    """A conversation that is strung together part by part."""

    def __init__(self, conv: object):
        self.conv, self.state, self.tail = conv, START, None
        self.counts, self.cost, self.audit = [0, 0, 0, 0], 0, []
        self.digest, self.empty = hashlib.sha256(), True

    def write(self, lines: str) -> None:
        self.digest.update((lines if self.empty else "\n" + lines).encode("utf-8", "surrogatepass"))
        self.empty = False

    def add(self, part: dict) -> None:
        for i, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.counts[i] += part[name]
        if self.tail is not None:
            self.counts[3] += self.tail + part["head"] not in LEGAL
        self.tail, self.state = part["tail"], part["leave"]
        self.cost += part["cost"]
        self.audit.append(part["audit"])
        if part["repaired"] is not None:
            self.write(part["repaired"])

    def row(self) -> tuple:
        for _ in CLOSING[self.state]:
            self.write(f"{WANTED[self.state]}:")
            self.state, self.cost = NEXT[self.state], self.cost + INSERT
            self.audit.append("I")
        return (self.conv, *self.counts, self.cost, "".join(self.audit), self.digest.hexdigest())


def strung(parts: DataFrame, conv_type: str) -> DataFrame:
    """One row a conversation, from its parts in order; of each part the edits
    that begin in the state the part before it ended in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, done, conv_kind = None, None, None
        for batch in batches:
            conv_kind, out = batch.schema.field("conv_id").type, []
            for part in batch.to_pylist():
                if whole is None or part["conv_id"] != whole.conv:
                    if whole is not None:
                        out.append(whole.row())
                    whole, done = Whole(part["conv_id"]), None
                if part["chunk"] != done and part["entry"] == whole.state:
                    done = part["chunk"]
                    whole.add(part)
            if out:
                yield rows(out, conv_kind)
        if whole is not None:
            yield rows([whole.row()], conv_kind)

    def rows(found: list[tuple], conv_kind: pa.DataType) -> pa.RecordBatch:
        types = [conv_kind] + [pa.int64()] * 5 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], ["conv_id", *(x.split()[0] for x in WHOLE.split(", "))])

    return by_conversation(parts, F.col("chunk")).mapInArrow(run, f"conv_id {conv_type}, {WHOLE}")


def repair(conversations: DataFrame, turns: DataFrame | None = None) -> DataFrame:
    """One row for each conv_id of ``conversations``: the faults and gaps of its
    ``turns`` (by default the rows themselves), the cheapest edits, their cost
    and the digest of the repaired conversation."""
    turns = conversations.select("conv_id", "turn", "role", "text") if turns is None else turns
    conv_type = conversations.schema["conv_id"].dataType.simpleString()
    rows, folder = in_order(turns)
    flagged = with_faults(rows)
    found = edits(flagged, costs_to_come(cost_tables(flagged, conv_type), conv_type), conv_type)
    done = strung(found, conv_type).withColumnRenamed("conv_id", "d_id")
    missing = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = rows.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0)).alias("gaps")).withColumnRenamed("conv_id", "g_id")
    out = conversations.select("conv_id").distinct()
    out = out.join(gaps, F.col("conv_id").eqNullSafe(F.col("g_id")), "left").join(done, F.col("conv_id").eqNullSafe(F.col("d_id")), "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    audit = F.coalesce("audit", F.lit("")).alias("audit")
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    return settle(out.select("conv_id", *counts, audit, digest), "repair", folder)


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """``repair`` of the rows as ``damaged`` leaves them."""
    return repair(conversations, damaged(conversations))
