"""Repair of conversations: least-cost edits, the least audit among them by ranked paths.

A repaired conversation has the role initials ``(s?(ua)+)?``. Four states tell what may
come next; the rows of a conversation, in order, are arcs between them: Delete, Keep,
Rerole, and before each row Insert. A dynamic program gives the cost from each node to
the end; an arc is optimal if it is part of a cheapest way on. The optimal arcs are then
ranked by the audits that begin with them: by their first letter, then, round by round,
by twice as many letters, from the pair of an arc's rank and that of the arc which its
pointer reaches; pointers double along. With the final ranks the least optimal arc at
the start is chosen, and the doubled pointers give the path that begins there. A stretch
of rows that must all be deleted is one arc, since it is the same in every state.

Nothing holds a conversation whole until the audit is put together:

1. Rows are narrow (a digest stands for the text), equal ones are counted as one, and
   are sorted by range over all conversations, so that a long one lies in many tasks.
2. A conversation's rows in one batch are a segment. Of segments that may go on in
   another batch, a 4 by 4 matrix of costs goes backward over the conversation, which
   gives each segment the costs behind it; and the state at its start goes forward.
3. Edits and texts meet once, sorted by conversation. There the repaired lines stream
   by, one at a time; a digest of them is sequential by its definition, so this is one
   task for each conversation.

Defined results for odd input: a null role or text is one space, as is a null id or turn
in the text that decides the damage. Rows without a turn come first; rows of one turn
are ordered by role, the first 32 characters of the text and a digest of it; equal rows
are repeats. Rows without a conversation are one conversation. Of a role only the first
character counts for the edits; one with another initial cannot be kept. Texts are taken
whole; other columns are left out, whatever their names; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytally.llm.common import MB, materialised, partitions, slices

# States: 0 at the start, 1 after a system row, 2 after a user row, 3 after an assistant's.
INSERTED = (2, 2, 3, 2)
ROLE_IN = ("user", "user", "assistant", "user")
# By initial (s, u, a, any other) and state: the state after the row is kept, or -1.
KEPT = ((1, -1, -1, -1), (2, 2, -1, 2), (-1, -1, 3, -1), (-1, -1, -1, -1))
INITIALS = {"s": 0, "u": 1, "a": 2}
LEGAL = {"su", "ua", "au"}
DELETE, INSERT, REROLE = 3, 2, 2
# The end, in each state: its cost, and the inserts that lead to a whole conversation.
AT_END, TAIL = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
NEVER = 1 << 60
# A step: a stretch to be deleted, or 2 * initial + whether it is truncated.
FORCED, END = -1, -2
LETTERS = np.frombuffer(b"?DIKR", np.uint8)
# Rows whose paths are ranked together.
RANKED_ROWS = 50_000
_WHITE = " \t\n\x0b\x0c\r"
_KEY = ["conv_id", "turn", "role", "head", "key"]


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with ``copies``, damaged by the crc32 of ``conv_id:turn``, mod 20.

    0 drops a row (no copies), 1 empties its text, 2 removes its sentence ends, 3 repeats
    it (two copies), 4 makes it a user's.
    """

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text, role = filled("text"), filled("role")
    without_ends = F.translate(text, ".!?", "")
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, without_ends).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with what orders and tells apart rows of one turn."""
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    ).select(
        "*",
        F.substring("text", 1, 32).alias("head"),
        F.substring(F.unhex(F.sha2("text", 256)), 1, 16).alias("key"),
    )


def _runs(keyed: DataFrame) -> DataFrame:
    """Equal rows of a turn as one, with their number and faults."""
    end = F.rtrim(F.col("text"), F.lit(_WHITE))
    marked = keyed.select(
        *_KEY,
        (end == "").alias("blank"),
        (~F.substring(end, -1, 1).isin(*".!?")).alias("truncated"),
        "copies",
    )
    runs = marked.groupBy(*_KEY, "blank", "truncated").agg(F.sum("copies").alias("copies"))
    # Role and text at several turns: all but those of the first turn are duplicates.
    there = runs.where("copies > 0 AND NOT blank").groupBy("conv_id", "role", "key")
    undated = F.max(F.col("turn").isNull())
    again = there.agg(F.count("*").alias("n"), undated.alias("undated"), F.min("turn").alias("t"))
    first = F.when(~F.col("undated"), F.col("t"))
    again = again.where("n > 1").select(
        *(F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "key")), first.alias("_turn")
    )
    same = [runs[c].eqNullSafe(again[f"_{c}"]) for c in ("conv_id", "role", "key")]
    later = F.col("_key").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_turn"))
    return runs.join(again, same, "left").select(*runs.columns, later.alias("later"))


def steps_of(forced: list, truncated: list, initials: list, copies: list) -> tuple[list, list]:
    """Steps of the rows of a segment with their numbers of rows, and the row of each."""
    steps, owners = [], []
    for k, n in enumerate(copies):
        if not n:
            continue
        if not forced[k]:
            kind = 2 * INITIALS.get(initials[k], 3) + bool(truncated[k])
            steps.append((kind, 1))
            owners.append(k)
            n -= 1
        if n:
            steps.append((FORCED, n))
            owners.append(k)
    return steps, owners


def costs_to_end(steps: list, behind: tuple | list) -> list:
    """Cost of the rest from each place and state, given the costs ``behind`` the steps."""
    now = list(behind)
    places = [now]
    for kind, n in reversed(steps):
        if kind == FORCED:
            now = [c + DELETE * n for c in now]
        else:
            kept, extra, after, now = KEPT[kind >> 1], kind & 1, now, []
            for state in range(4):
                least = min(after[state] + DELETE, after[INSERTED[state]] + REROLE + extra)
                if kept[state] >= 0:
                    least = min(least, after[kept[state]] + extra)
                now.append(least)
        now[2], now[3] = min(now[2], now[3] + INSERT), min(now[3], now[2] + INSERT)
        now[0], now[1] = min(now[0], now[2] + INSERT), min(now[1], now[2] + INSERT)
        places.append(now)
    places.reverse()
    return places


class Paths:
    """The least audits through segments, by ranks of their optimal arcs."""

    def __init__(self, segments: list[tuple[list, tuple | list]]) -> None:
        """``segments`` are steps and the costs behind them."""
        costs, kinds, counts, begins = [], [], [], []
        for steps, behind in segments:
            begins.append(len(costs))
            costs += costs_to_end(steps, behind)
            kinds += [kind for kind, _ in steps] + [END]
            counts += [n for _, n in steps] + [0]
        self.costs = np.array(costs, np.int64).reshape(-1, 4)
        self.counts = np.array(counts, np.int64)
        self.kinds = np.array(kinds, np.int64)
        self.begins = np.array(begins, np.int64)
        self.ends = np.append(self.begins[1:], len(kinds)) - 1
        self._arcs()
        self._rank()

    def _arcs(self) -> None:
        """All optimal arcs: node they leave, letter, node they reach."""
        found = []
        moves, normal = self.kinds != END, self.kinds >= 0
        extra = np.where(normal, self.kinds & 1, 0)
        kept = np.array(KEPT)[np.where(normal, self.kinds >> 1, 3)]
        at = np.arange(len(self.kinds))
        for state in range(4):
            here = self.costs[:, state]
            to = INSERTED[state]
            deletes = DELETE * np.where(normal, 1, self.counts)
            kinds = (
                (1, moves, deletes, at + 1, np.full(len(at), state)),
                (2, moves, np.full(len(at), INSERT), at, np.full(len(at), to)),
                (3, normal & (kept[:, state] >= 0), extra, at + 1, kept[:, state]),
                (4, normal, REROLE + extra, at + 1, np.full(len(at), to)),
            )
            for letter, there, cost, place, next_state in kinds:
                k = at[there & (here < NEVER // 2)]
                k = k[here[k] == cost[k] + self.costs[place[k], next_state[k]]]
                found.append((4 * k + state, np.full(len(k), letter), 4 * place[k] + next_state[k]))
        leaves, letters, reaches = (np.concatenate(part) for part in zip(*found, strict=True))
        order = np.lexsort((letters, leaves))
        self.leaves, self.letters, self.reaches = leaves[order], letters[order], reaches[order]

    def _first_arc(self, nodes: np.ndarray) -> np.ndarray:
        """The arc of least rank so far that leaves each node; one past all at an end."""
        arc = np.searchsorted(self.leaves, nodes)
        return np.where(self.kinds[nodes >> 2] == END, len(self.leaves), arc)

    def _rank(self) -> None:
        """Ranks by 1, 2, 4, ... letters, and pointers as many arcs ahead."""
        past = len(self.leaves)
        rank = np.append(self.letters, 0)
        pointer = np.append(self._first_arc(self.reaches), past).astype(np.int32)
        self.pointers = []
        while True:
            self.pointers.append(pointer)
            if (pointer == past).all():
                break
            pairs = rank * (int(rank.max()) + 1) + rank[pointer]
            rank = np.unique(pairs, return_inverse=True)[1]
            pointer = pointer[pointer]
        # From now on the arcs of a node stand in order of their whole audits.
        order = np.lexsort((rank[:-1], self.leaves))
        self.by_rank = order

    def least(self, state: int) -> list[tuple[str, int, int] | None]:
        """For each segment entered in ``state``: its audit, cost, and the state behind."""
        start = 4 * self.begins + state
        entered = self.costs[self.begins, state]
        possible = entered < NEVER // 2
        goes = np.flatnonzero(possible & (self.begins < self.ends))
        arcs = self.by_rank[np.searchsorted(self.leaves, start[goes])]
        owner, at = goes, np.zeros(len(goes), np.int64)
        for level in reversed(range(len(self.pointers))):
            ahead = self.pointers[level][arcs]
            on = ahead < len(self.leaves)
            arcs = np.concatenate([arcs, ahead[on]])
            owner = np.concatenate([owner, owner[on]])
            at = np.concatenate([at, at[on] + (1 << level)])
        order = np.lexsort((at, owner))
        arcs, owner = arcs[order], owner[order]
        letters = self.letters[arcs]
        # A deletion takes the whole stretch that must go, any other arc one row or none.
        place = self.leaves[arcs] >> 2
        times = np.where(self.kinds[place] == FORCED, self.counts[place], 1)
        times = np.where(letters == 1, times, 1)
        text = np.repeat(LETTERS[letters], times).tobytes().decode("ascii")
        size = np.zeros(len(self.begins) + 1, np.int64)
        np.add.at(size, owner + 1, times)
        cuts = np.cumsum(size)
        last = np.full(len(self.begins), state)
        last[owner] = self.reaches[arcs] & 3  # the last arc of each segment stays
        spent = entered - self.costs[self.ends, last]
        return [
            (text[cuts[k] : cuts[k + 1]], int(spent[k]), int(last[k])) if possible[k] else None
            for k in range(len(self.begins))
        ]


def _offsets(sizes: list[int]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())


_LISTS = {
    "turns": ("turn", "long"),
    "roles": ("role", "string"),
    "heads": ("head", "string"),
    "keys": ("key", "binary"),
    "forced": ("forced", "boolean"),
    "cut": ("truncated", "boolean"),
    "copies": ("copies", "long"),
}
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns_seen")


def _segments(runs: DataFrame) -> DataFrame:
    """The rows of one conversation in one sorted batch, as lists, with their counts.

    ``seg`` numbers them in order. Those at either end of a batch are ``open``: they may
    go on in another, and have the matrix of their costs.
    """
    ordered = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "head", "key"]
    forced = F.col("blank") | F.col("later")
    rows = runs.withColumn("forced", forced)
    rows = rows.repartitionByRange(partitions(runs, 16 * MB), *ordered)
    rows = rows.sortWithinPartitions(*ordered)
    conv = T.StructType([runs.schema["conv_id"]])
    conv_ddl = f"conv_id {conv['conv_id'].dataType.simpleString()}"
    schema = (
        f"{conv_ddl}, seg long, open boolean, "
        + ", ".join(f"{c} long" for c in _COUNTS)
        + ", first string, last string, least_turn long, most_turn long, matrix array<long>, "
        + ", ".join(f"{name} array<{kind}>" for name, (_, kind) in _LISTS.items())
    )

    def counts_of(faults, initials, turns, copies) -> tuple:
        blank = duplicate = truncated = illegal = seen = 0
        first = last = least = most = None
        for (is_blank, is_later, is_cut), initial, turn, n in zip(
            faults, initials, turns, copies, strict=True
        ):
            if not n:
                continue
            if is_blank:
                blank += n
            elif is_later:
                duplicate += n
            else:
                duplicate += n - 1
                truncated += is_cut
            illegal += n - 1 + (last is not None and last + initial not in LEGAL)
            first, last = initial if first is None else first, initial
            if turn is not None:
                seen += turn != most
                least, most = turn if least is None else least, turn
        return blank, duplicate, truncated, illegal, seen, first, last, least, most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            column = {name: batch.column(name).to_pylist() for name in
                      ("conv_id", "turn", "role", "blank", "later", "truncated", "forced", "copies")}
            initials = [role[:1] for role in column["role"]]
            faults = list(zip(column["blank"], column["later"], column["truncated"], strict=True))
            ids, sizes, measured, matrices = [], [], [], []
            begin = 0
            for conv_id, group in groupby(column["conv_id"]):
                end = begin + sum(1 for _ in group)
                part = slice(begin, end)
                ids.append(conv_id)
                sizes.append(end - begin)
                measured.append(
                    counts_of(faults[part], initials[part], column["turn"][part], column["copies"][part])
                )
                matrix = None
                if begin == 0 or end == batch.num_rows:
                    steps, _ = steps_of(
                        column["forced"][part], column["truncated"][part], initials[part],
                        column["copies"][part],
                    )
                    only = [[0 if k == e else NEVER for k in range(4)] for e in range(4)]
                    ways = [costs_to_end(steps, behind)[0] for behind in only]
                    matrix = [min(ways[e][q], NEVER) for q in range(4) for e in range(4)]
                matrices.append(matrix)
                begin = end
            if not ids:
                continue
            base = (task << 40) + (number << 20)
            *counts, firsts, lasts, leasts, mosts = zip(*measured, strict=True)
            offsets = _offsets(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, batch.schema.field("conv_id").type),
                    pa.array(range(base, base + len(ids)), pa.int64()),
                    pa.array([m is not None for m in matrices]),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array(firsts, pa.string()),
                    pa.array(lasts, pa.string()),
                    pa.array(leasts, pa.int64()),
                    pa.array(mosts, pa.int64()),
                    pa.array(matrices, pa.list_(pa.int64())),
                    *(
                        pa.ListArray.from_arrays(offsets, batch.column(source))
                        for source, _ in _LISTS.values()
                    ),
                ],
                names=["conv_id", "seg", "open", *_COUNTS, "first", "last", "least_turn",
                       "most_turn", "matrix", *_LISTS],
            )

    return materialised(rows.mapInArrow(run, schema), "segments")


def _costs_behind(segments: DataFrame) -> DataFrame:
    """(seg, behind): the costs behind each open segment, from the last one backward."""
    rows = segments.where("open").select("conv_id", "seg", "matrix").repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", F.desc("seg"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, now = object(), None
        for batch in batches:
            out = []
            conv_ids, _, matrices = (c.to_pylist() for c in batch.columns)
            for conv_id, matrix in zip(conv_ids, matrices, strict=True):
                if conv_id != current:
                    current, now = conv_id, AT_END
                out.append(now)
                ways = ([matrix[4 * q + e] + now[e] for e in range(4)] for q in range(4))
                now = [min(*costs, NEVER) for costs in ways]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(out, pa.list_(pa.int64()))], names=["seg", "behind"]
            )

    return rows.mapInArrow(run, "seg long, behind array<long>")


def _solved(segments: DataFrame) -> DataFrame:
    """``segments`` with the least audit, its cost and the state behind, by entry state."""
    whole = segments.where("NOT open").withColumn("behind", F.array(*map(F.lit, AT_END)).cast("array<long>"))
    rows = whole.unionByName(segments.where("open").join(_costs_behind(segments), "seg"))
    rows = rows.drop("matrix")
    ways = "audits array<string>, spent array<long>, ends array<int>"
    schema = f"{rows.drop('behind')._jdf.schema().toDDL()}, {ways}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("copies")).to_pylist()
            for first, last in slices(sizes, RANKED_ROWS):
                part = batch.slice(first, last - first)
                lists = (part.column(c).to_pylist() for c in ("forced", "cut", "roles", "copies", "behind"))
                segments = []
                for forced, cut, roles, copies, behind in zip(*lists, strict=True):
                    steps, _ = steps_of(forced, cut, [r[:1] for r in roles], copies)
                    segments.append((steps, behind))
                if not segments:
                    continue
                paths = Paths(segments)
                found = list(zip(*(paths.least(state) for state in range(4)), strict=True))
                ways = [[[w and w[k] for w in four] for four in found] for k in range(3)]
                kept = [n for n in part.schema.names if n != "behind"]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(n) for n in kept),
                        pa.array(ways[0], pa.list_(pa.string())),
                        pa.array(ways[1], pa.list_(pa.int64())),
                        pa.array(ways[2], pa.list_(pa.int32())),
                    ],
                    names=[*kept, "audits", "spent", "ends"],
                )

    return materialised(rows.mapInArrow(run, schema), "solved")


def _entered(solved: DataFrame) -> DataFrame:
    """Per open segment: the state at its start, whether its first row breaks a rule or
    repeats a turn of the segment before, and the inserts at the conversation's end."""
    used = ("conv_id", "seg", "ends", "first", "last", "least_turn", "most_turn")
    rows = solved.where("open").select(*used).repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "seg")
    schema = "seg long, entry int, joint_illegal long, joint_turns long, tail string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, initial, turn = object(), 0, None, None
        waiting = None  # the last segment so far; only the next row tells if it is the end
        for batch in batches:
            out = []
            for conv_id, seg, ends, first, last, least, most in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if waiting:
                    tail = TAIL[state] if conv_id != current else ""
                    out.append((*waiting, tail))
                if conv_id != current:
                    current, state, initial, turn = conv_id, 0, None, None
                joins = first is not None and initial is not None
                illegal = int(joins and initial + first not in LEGAL)
                waiting = (seg, state, illegal, int(least is not None and least == turn))
                state = ends[state]
                initial = initial if last is None else last
                turn = turn if most is None else most
            yield _rows(out, schema)
        if waiting:
            yield _rows([(*waiting, TAIL[state])], schema)

    return rows.mapInArrow(run, schema)


def _rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [field.split() for field in ddl.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[] for _ in fields]
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def plan(rows: DataFrame) -> DataFrame:
    """The segments of all conversations with the edits chosen for them.

    ``rows``: conv_id, turn, role, text and copies (0: the row is gone, but its
    conversation is there). ``audit`` is the segment's part of the audit, ``tail`` the
    inserts behind the last row.
    """
    runs = materialised(_runs(_keyed(rows)), "runs")
    solved = _solved(_segments(runs))
    whole = solved.where("NOT open").select(
        "*",
        F.lit(0).alias("entry"),
        F.lit(0).cast("long").alias("joint_illegal"),
        F.lit(0).cast("long").alias("joint_turns"),
        F.get(F.array(*map(F.lit, TAIL)), F.get("ends", F.lit(0))).alias("tail"),
    )
    parts = whole.unionByName(solved.where("open").join(_entered(solved), "seg"))
    chosen = {"audit": F.get("audits", F.col("entry")), "cost": F.get("spent", F.col("entry"))}
    return materialised(parts.withColumns(chosen).drop("audits", "spent", "ends"), "edits")


def audits(planned: DataFrame) -> DataFrame:
    """Counts of faults, the cost and the whole audit of each conversation."""
    one = F.struct("seg", F.concat("audit", "tail").alias("audit"))
    in_order = F.array_sort(F.collect_list(one))
    seen = F.sum("turns_seen") - F.sum("joint_turns")
    return planned.groupBy("conv_id").agg(
        F.coalesce(F.max("most_turn") - F.min("least_turn") + 1 - seen, F.lit(0)).alias("gaps"),
        F.sum("blank").alias("blank"),
        F.sum("duplicate").alias("duplicate"),
        F.sum("truncated").alias("truncated"),
        (F.sum("illegal") + F.sum("joint_illegal")).alias("illegal"),
        (F.sum("cost") + INSERT * F.sum(F.length("tail"))).alias("cost"),
        F.array_join(F.transform(in_order, lambda s: s["audit"]), "").alias("audit"),
    )


def _edited(planned: DataFrame) -> DataFrame:
    """One row per row of a conversation that stays or has inserts before it.

    ``inserts`` are states in which user or assistant rows are inserted before it;
    ``becomes`` is its role, or null if it goes. ``late`` marks what follows all rows.
    """
    conv_ddl = f"conv_id {planned.schema['conv_id'].dataType.simpleString()}"
    key = "turn long, role string, head string, key binary"
    schema = f"{conv_ddl}, late boolean, {key}, inserts array<int>, becomes string"
    names = ["conv_id", "late", "turn", "role", "head", "key", "inserts", "becomes"]

    def edits(turns, roles, heads, keys, forced, cut, copies, audit, tail, state) -> Iterator:
        steps, owners = steps_of(forced, cut, [r[:1] for r in roles], copies)
        at, inserts = 0, []
        for (kind, n), k in zip(steps, owners, strict=True):
            while audit[at] == "I":
                inserts.append(state)
                state, at = INSERTED[state], at + 1
            letter, becomes = audit[at], None
            if letter == "K":
                becomes, state = roles[k], KEPT[kind >> 1][state]
            elif letter == "R":
                becomes, state = ROLE_IN[state], INSERTED[state]
            at += n
            if inserts or becomes is not None:
                yield False, turns[k], roles[k], heads[k], keys[k], inserts, becomes
                inserts = []
        for _ in tail:
            inserts.append(state)
            state = INSERTED[state]
        if inserts:
            yield True, None, None, None, None, inserts, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("copies")).to_pylist()
            for first, last in slices(sizes, RANKED_ROWS):
                part = batch.slice(first, last - first)
                out = []
                for conv_id, *rest in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    out += ((conv_id, *edit) for edit in edits(*rest))
                columns = list(zip(*out, strict=True)) or [[] for _ in names]
                types = [part.schema.field("conv_id").type, pa.bool_(), pa.int64(), pa.string(),
                         pa.string(), pa.binary(), pa.list_(pa.int32()), pa.string()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    lists = ("turns", "roles", "heads", "keys", "forced", "cut", "copies")
    used = planned.select("conv_id", *lists, "audit", "tail", "entry")
    return used.mapInArrow(run, schema)


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``conv_id, place, role, text``: the repaired conversations, each in one partition
    and in order. An edit and the text that it is about meet by sorting."""
    edits = _edited(planned).select("*", F.lit(None).cast("string").alias("text"))
    texts = _keyed(rows).where("copies > 0").select(
        "conv_id",
        F.lit(False).alias("late"),
        *_KEY[1:],
        F.lit(None).cast("array<int>").alias("inserts"),
        F.lit(None).cast("string").alias("becomes"),
        "text",
    )
    is_text = F.col("text").isNotNull()
    met = edits.unionByName(texts).repartition("conv_id")
    met = met.sortWithinPartitions("conv_id", "late", "turn", "role", "head", "key", is_text)
    conv_ddl = f"conv_id {planned.schema['conv_id'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, place, wanted, becomes = object(), 0, None, None
        for batch in batches:
            out = []
            for conv_id, _, turn, role, _, key, inserts, new_role, text in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if conv_id != current:
                    current, place, wanted = conv_id, 0, None
                lines = []
                if text is None:
                    lines = [(ROLE_IN[state], "") for state in inserts]
                    wanted, becomes = (turn, role, key), new_role
                elif becomes is not None and wanted == (turn, role, key):
                    lines = [(becomes, text)]
                    wanted = None
                out += ((conv_id, place + k, *line) for k, line in enumerate(lines))
                place += len(lines)
            columns = list(zip(*out, strict=True)) or [[]] * 4
            types = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["conv_id", "place", "role", "text"],
            )

    return met.mapInArrow(run, f"{conv_ddl}, place long, role string, text string")


def digests(lines: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text``, joined by newlines, of the conversations of ``repaired``."""
    conv_ddl = f"conv_id {lines.schema['conv_id'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, kind = object(), None, None
        for batch in batches:
            done, kind = [], batch.schema.field("conv_id").type
            for conv_id, _, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv_id != current or digest is None:
                    if digest:
                        done.append((current, digest.hexdigest()))
                    current, digest = conv_id, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield _digests(done, kind)
        if digest:
            yield _digests([(current, digest.hexdigest())], kind)

    return lines.mapInArrow(run, f"{conv_ddl}, repaired_sha256 string")


def _digests(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    ids, values = zip(*rows, strict=True) if rows else ([], [])
    columns = [pa.array(ids, kind), pa.array(values, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", "repaired_sha256"])


def report(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and a digest of the repaired rows of each conversation."""
    planned = plan(rows)
    found = digests(repaired(rows, planned)).withColumnRenamed("conv_id", "__id")
    whole = audits(planned)
    nothing = F.lit(hashlib.sha256().hexdigest())
    return whole.join(found, F.col("conv_id").eqNullSafe(F.col("__id")), "left").select(
        *whole.columns, F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )
