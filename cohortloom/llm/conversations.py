"""Repair of the role structure of conversations by the cheapest edits.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``: perhaps a system
message, then user and assistant in turn; or nothing. Edits: keep a row (K, 0), give it
the role that is due (R, 3), delete it (D, 4; the only edit of blank and duplicate rows), insert an empty
message of the role that is due (I, 3). A truncated row that stays costs 3 more. The cheapest
edits are found by dynamic programming over four states (nothing yet, after s, after u, after a);
of equally cheap ones the one whose letters are least in ASCII is taken, by walking forward along tight costs.

The walk needs the costs behind it, from the end backwards. They are kept only at checkpoints: a
conversation is cut into blocks of at most ``BLOCK`` consecutive rows, whose cost vectors come from a scan over their
4 by 4 transfer costs, and inside a block a vector is kept every square root of its length; the stretch between two
checkpoints is computed again while the walk goes through it. So any conversation is spread over
tasks, and a task holds a square root of a block's vectors for each block at hand.

In Spark: rows (without their texts) are aggregated to one a (turn, role, text), first
occurrences come from a second aggregate, a range partitioning by conversation and turn makes
blocks. Nearly all conversations are one block and are solved where they lie; the others take two scans over
one small row a block. Edits then join the texts, once, by row.

Order: by turn, nulls first, then role, then the SHA-256 of role and text; so rows of one turn have a defined order and equal rows
are neighbours. A null role or text is one space; a null conversation id is a conversation of its own. Equal rows count as often as
they stand. Ids and turns are integers. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .kit import cut, parts

BLOCK = 4096
#: Blocks solved at once.
AT_ONCE = 1024
SPACE = " \t\n\x0b\f\r"
INFINITE = 1 << 60
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3

#: States: nothing yet, after s, after u, after a. DUE: the state that the role due leads to (2: user, 3: assistant).
DUE = np.array([2, 2, 3, 2])
#: Costs at the end of a conversation: s and u still need their rest.
AT_END = np.array([0, 2 * INSERT, INSERT, 0], dtype=np.int64)
#: Kinds of rows: initials s, u, a, any other; the same, truncated; rows that must go.
MUST_GO = 8
INITIALS = "sua"
_EMIT = np.full((9, 4), INFINITE, dtype=np.int64)
_SYSTEM = np.full(9, INFINITE, dtype=np.int64)
_KEPT = np.zeros((9, 4), dtype=bool)
for _kind in range(8):
    _more = CUT_OFF * (_kind >= 4)
    _KEPT[_kind] = DUE == {1: 2, 2: 3}.get(_kind % 4, -1)
    _EMIT[_kind] = np.where(_KEPT[_kind], KEEP, REROLE) + _more
    if _kind % 4 == 0:
        _SYSTEM[_kind] = KEEP + _more


def _before(kind: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs before rows of these kinds, insertions included, from the costs after them (last axis: state)."""
    extra = (slice(None),) + (None,) * (after.ndim - 2)
    s = np.minimum(DELETE + after, _EMIT[kind][extra + (slice(None),)] + after[..., DUE])
    s[..., 0] = np.minimum(s[..., 0], _SYSTEM[kind][extra] + after[..., 1])
    two, three = np.minimum(s[..., 2], INSERT + s[..., 3]), np.minimum(s[..., 3], INSERT + s[..., 2])
    return np.stack([np.minimum(s[..., 0], INSERT + two), np.minimum(s[..., 1], INSERT + two), two, three], axis=-1)


class Blocks:
    """Blocks of row kinds, longest first, padded: what goes back and forth through them at once."""

    def __init__(self, kinds: list[np.ndarray]):
        sizes = np.array([len(k) for k in kinds], dtype=np.int64)
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.most = int(self.sizes[0]) if len(kinds) else 0
        self.kinds = np.zeros((len(kinds), self.most), dtype=np.uint8)
        for to, k in enumerate(self.order):
            self.kinds[to, : sizes[k]] = kinds[k]
        #: Blocks that have a row at each place.
        self.live = np.searchsorted(-self.sizes, -np.arange(self.most), "left")

    def back(self, costs: np.ndarray, start: int, stop: int, seen=None) -> np.ndarray:
        """Costs before place start from those before place stop; seen(place, costs) is told each on the way."""
        costs = costs.copy()
        for place in range(stop - 1, start - 1, -1):
            n = self.live[place]
            costs[:n] = _before(self.kinds[:n, place], costs[:n])
            if seen:
                seen(place, costs)
        return costs

    def transfer(self) -> np.ndarray:
        """For each block, in the order given, the least costs from each state before it to each state after it."""
        ends = np.full((4, 4), INFINITE, dtype=np.int64)
        np.fill_diagonal(ends, 0)
        found = self.back(np.repeat(ends[None], len(self.sizes), axis=0), 0, self.most)
        out = np.empty_like(found)
        out[self.order] = found
        return np.minimum(out, INFINITE).transpose(0, 2, 1)

    def walk(self, ends: np.ndarray, states: np.ndarray):
        """The least cheapest edits of each block, from its state before and the costs after it, as given.

        Returns the states after and the edits in order: (block, letter, place of the row, state after).
        """
        step = max(1, isqrt(self.most))
        costs, state = ends[self.order].astype(np.int64), states[self.order].copy()
        kept = {}
        self.back(costs, 0, self.most, lambda place, c: kept.__setitem__(place, c.copy()) if place % step == 0 else None)
        events = []
        for start in range(0, self.most, step):
            stop = min(start + step, self.most)
            after = kept.get(stop, costs)
            segment = {stop: after}
            self.back(after, start, stop, lambda place, c, segment=segment: segment.__setitem__(place, c.copy()))
            for place in range(start, stop):
                self._pass(place, segment[place], segment[place + 1], state, events)
        events.append((np.zeros(0, dtype=np.int64),) * 4)
        block, letter, at, after = (np.concatenate(x) for x in zip(*events))
        block = self.order[block]
        by = np.argsort(block, kind="stable")
        out = np.empty_like(state)
        out[self.order] = state
        return out, block[by], letter[by], at[by], after[by]

    def _pass(self, place, before, after, state, events):
        todo = np.arange(self.live[place])
        while len(todo):
            q, kind = state[todo], self.kinds[todo, place]
            goal, due = before[todo, q], DUE[q]
            deleted = DELETE + after[todo, q] == goal
            inserted = ~deleted & (INSERT + before[todo, due] == goal)
            system = ~deleted & ~inserted & (q == 0) & (_SYSTEM[kind] + after[todo, 1] == goal)
            letter = np.where(deleted, ord("D"), np.where(inserted, ord("I"), np.where(system | _KEPT[kind, q], ord("K"), ord("R"))))
            to = np.where(deleted, q, np.where(system, 1, due))
            state[todo] = to
            events.append((todo, letter, np.where(inserted, -1, place), to))
            todo = todo[inserted]


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of conversations, damaged by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space).

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(named) % 20).alias("_code")).where("_code <> 0")
    text = F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_code") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


CONV, TURN = ["c0", "c1"], ["t0", "t1"]


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with null-free keys: conversation and turn as a flag and a long, h: the hash of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    kept = rows.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    h = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    pair = lambda c, a, b: [F.col(c).isNotNull().alias(a), F.coalesce(c, F.lit(0)).alias(b)]
    return kept.select(*pair("conv", *CONV), *pair("turn", *TURN), "role", "text", h.alias("h"))


def _skeleton(keyed: DataFrame) -> DataFrame:
    """One row a different (turn, role, text): kind, copies, whether it is a duplicate, no text."""
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    initial = F.instr(F.lit(INITIALS), F.coalesce(F.nullif(F.left("role", F.lit(1)), F.lit("")), F.lit("?"))) - 1
    seen = keyed.select(*CONV, *TURN, "role", "h", F.when(initial < 0, 3).otherwise(initial).cast("int").alias("initial"), (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("cut_off"))
    rows = seen.groupBy(*seen.columns).agg(F.count("*").alias("copies"))
    firsts = seen.groupBy(*CONV, "h").agg(F.min(F.struct(*TURN)).alias("x")).select(*CONV, "x.*", "h", F.lit(True).alias("first"))
    return rows.join(firsts, [*CONV, *TURN, "h"], "left").withColumn("duplicate", F.col("first").isNull()).drop("first")


_SUMMARY = "blank long, duplicate long, truncated long, illegal long, turns long, first string, last string, t_first long, t_last long, t_least long, t_most long"
_ROWS = "kinds binary, copies array<long>, t0 array<boolean>, t1 array<long>, h array<binary>"
_BLOCK = f"c0 boolean, c1 long, part int, n int, alone boolean, {_ROWS}, {_SUMMARY}, transfer array<long>"
LEGAL = ("su", "ua", "au")


def _block(rows: dict, a: int, b: int) -> dict:
    """What is known of the rows a to b without their neighbours."""
    blank, duplicate, cut_off, copies, initial = (rows[c][a:b] for c in ("blank", "duplicate", "cut_off", "copies", "initial"))
    must_go = blank | duplicate
    kinds = np.where(must_go, MUST_GO, initial + 4 * cut_off).astype(np.uint8)
    names = "".join("sua?"[i] for i in initial.tolist())
    illegal = int((copies - 1).sum()) + sum(names[i : i + 2] not in LEGAL for i in range(len(names) - 1))
    turns = rows["t1"][a:b][rows["t0"][a:b]]
    at = lambda i: int(rows["t1"][i]) if rows["t0"][i] else None
    return {
        "kinds": kinds.tobytes(), "copies": copies.tolist(), "t0": rows["t0"][a:b].tolist(), "t1": rows["t1"][a:b].tolist(), "h": rows["h"][a:b],
        "blank": int(copies[blank].sum()), "duplicate": int(np.where(duplicate, copies, copies - 1)[~blank].sum()), "truncated": int((cut_off & ~must_go).sum()),
        "illegal": illegal, "turns": len(np.unique(turns)), "first": names[0], "last": names[-1], "t_first": at(a), "t_last": at(b - 1),
        "t_least": int(turns.min()) if len(turns) else None, "t_most": int(turns.max()) if len(turns) else None,
    }


def _cut_blocks(batches, schema: pa.Schema):
    """Blocks of the sorted rows of a partition. Conversations that begin or end it may go on elsewhere."""
    part, n, first_run, begun, pending = TaskContext.get().partitionId(), 0, True, False, None

    def emit(table, pieces):
        nonlocal n
        rows = {c: table.column(c).to_numpy() for c in ("c0", "c1", "t0", "t1", "initial", "blank", "cut_off", "duplicate", "copies")} | {"h": table.column("h").to_pylist()}
        blocks = []
        for a, b, alone in pieces:
            blocks.append({"c0": bool(rows["c0"][a]), "c1": int(rows["c1"][a]), "part": part, "n": n, "alone": alone} | _block(rows, a, b))
            n += 1
        shared = [k for k, x in enumerate(blocks) if not x["alone"]]
        found = Blocks([np.frombuffer(blocks[k]["kinds"], np.uint8) for k in shared]).transfer() if shared else []
        for k, t in zip(shared, found):
            blocks[k]["transfer"] = t.ravel().tolist()
        for at in range(0, len(blocks), 256):
            yield pa.RecordBatch.from_pylist(blocks[at : at + 256], schema=schema)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = (pa.concat_tables([pending, table]) if pending is not None else table).combine_chunks()
        if not table.num_rows:
            continue
        c0, c1 = (table.column(c).to_numpy() for c in CONV)
        starts = np.concatenate([[0], 1 + np.flatnonzero((c0[1:] != c0[:-1]) | (c1[1:] != c1[:-1]))])
        pieces = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            alone = not first_run and not begun and b - a <= BLOCK
            pieces += [(x, min(x + BLOCK, b), alone) for x in range(a, b, BLOCK)]
            first_run = begun = False
        a = int(starts[-1])
        while table.num_rows - a > BLOCK:  # the last conversation goes on
            pieces.append((a, a + BLOCK, False))
            a, begun = a + BLOCK, True
        pending = table.slice(a)
        if pieces:
            yield from emit(table, pieces)
    if pending is not None and pending.num_rows:
        yield from emit(pending.combine_chunks(), [(0, pending.num_rows, False)])


_WHICH = ["c0", "c1", "part", "n"]


def _scan_back(group: pa.Table) -> pa.Table:
    """Costs after each block of a conversation, from the last one backwards."""
    rows = group.select([*_WHICH, "transfer"]).to_pylist()
    rows.sort(key=lambda r: (r["part"], r["n"]))
    after = AT_END
    for k in range(len(rows) - 1, -1, -1):
        rows[k]["after"], rows[k]["final"] = after.tolist(), k == len(rows) - 1
        s = (np.array(rows[k].pop("transfer"), dtype=np.int64).reshape(4, 4) + after).min(axis=1)
        after = np.minimum(s, INFINITE)
    return pa.Table.from_pylist(rows, schema=pa.schema([("c0", pa.bool_()), ("c1", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("after", pa.list_(pa.int64())), ("final", pa.bool_())]))


def _try_starts(batches):
    """For blocks with the costs after them: state after and messages left, for each state before."""
    schema = pa.schema([("c0", pa.bool_()), ("c1", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("to", pa.list_(pa.int64())), ("left", pa.list_(pa.int64()))])
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE // 4):
            some = batch.slice(at, AT_ONCE // 4)
            kinds = [np.frombuffer(k, np.uint8) for k in some.column("kinds").to_pylist() for _ in range(4)]
            ends = np.repeat(np.array(some.column("after").to_pylist(), dtype=np.int64), 4, axis=0)
            to, block, letter, _, _ = Blocks(kinds).walk(ends, np.tile(np.arange(4), some.num_rows))
            left = np.bincount(block[letter != ord("D")], minlength=len(kinds))
            yield pa.RecordBatch.from_arrays([*(some.column(c) for c in _WHICH), pa.array(to.reshape(-1, 4).tolist(), pa.list_(pa.int64())), pa.array(left.reshape(-1, 4).tolist(), pa.list_(pa.int64()))], schema=schema)


def _scan_forward(group: pa.Table) -> pa.Table:
    """State before each block of a conversation, and messages before it."""
    rows, state, before = group.to_pylist(), 0, 0
    rows.sort(key=lambda r: (r["part"], r["n"]))
    for r in rows:
        r["state"], r["before"] = state, before
        before += r.pop("left")[state]
        state = r.pop("to")[state]
    return pa.Table.from_pylist(rows, schema=pa.schema([("c0", pa.bool_()), ("c1", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("state", pa.int32()), ("before", pa.int64())]))


_EDITED = f"c0 boolean, c1 long, part int, n int, {_SUMMARY}, cost long, audit string, t0 array<boolean>, t1 array<long>, h array<binary>, roles array<string>, before long"


def _edit(batches, schema: pa.Schema):
    """Edits of blocks whose state before and costs after are known: letters, cost, and each message left, in order.

    A message left has the key of its row (h null: inserted) and its new role (null: its own).
    """
    carried = schema.names[: schema.names.index("cost")]
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            some = batch.slice(at, AT_ONCE)
            kinds = [np.frombuffer(k, np.uint8) for k in some.column("kinds").to_pylist()]
            ends = np.array(some.column("after").to_pylist(), dtype=np.int64)
            to, block, letter, place, after = Blocks(kinds).walk(ends, some.column("state").to_numpy().astype(np.int64))
            first = np.searchsorted(block, np.arange(len(kinds) + 1))
            copies, t0, t1, h = (some.column(c).to_pylist() for c in ("copies", "t0", "t1", "h"))
            out = {c: [] for c in ("cost", "audit", "t0", "t1", "h", "roles")}
            for k in range(len(kinds)):
                span = slice(first[k], first[k + 1])
                letters, places, states = letter[span].tolist(), place[span].tolist(), after[span].tolist()
                more = 0
                audit, messages = [], []
                for c, p, q in zip(letters, places, states):
                    audit.append(chr(c))
                    if p >= 0 and copies[k][p] > 1:  # all copies but the first are duplicates
                        audit.append("D" * (copies[k][p] - 1))
                        more += DELETE * (copies[k][p] - 1)
                    if c != ord("D"):
                        role = None if c == ord("K") else "user" if q == 2 else "assistant"
                        messages.append((t0[k][p], t1[k][p], h[k][p], role) if p >= 0 else (None, None, None, role))
                        more += CUT_OFF * (p >= 0 and 4 <= kinds[k][p] < MUST_GO)
                if some.column("final")[k].as_py():
                    for q in {1: (2, 3), 2: (3,)}.get(int(to[k]), ()):
                        letters.append(ord("I"))
                        audit.append("I")
                        messages.append((None, None, None, "user" if q == 2 else "assistant"))
                price = {ord("D"): DELETE, ord("I"): INSERT, ord("K"): KEEP, ord("R"): REROLE}
                out["cost"].append(int(more + sum(price[c] for c in letters)))
                out["audit"].append("".join(audit))
                for name, values in zip(("t0", "t1", "h", "roles"), zip(*messages) if messages else ((), (), (), ())):
                    out[name].append(list(values))
            arrays = [some.column(c) for c in carried] + [pa.array(out[c], type=schema.field(c).type) for c in out] + [some.column("before")]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


@dataclass(frozen=True)
class Repaired:
    """``conversations``: one row a conversation with its faults, cost and audit; ``messages``: the rows left, by position."""

    conversations: DataFrame
    messages: DataFrame


def repair(rows: DataFrame) -> Repaired:
    """Repairs conversations (conv_id, turn, role, text).

    conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. messages: conv_id, position (from 0), role, text.
    """
    spark = rows.sparkSession
    keyed = _keyed(rows)
    order = [*CONV, *TURN, "role", "h"]
    skeleton = cut(_skeleton(keyed)).select(*order, "initial", "blank", "cut_off", "duplicate", "copies")
    sorted_rows = skeleton.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
    block_schema, edit_schema = (to_arrow_schema(T.StructType.fromDDL(ddl)) for ddl in (_BLOCK, _EDITED))
    blocks = cut(sorted_rows.mapInArrow(lambda batches: _cut_blocks(batches, block_schema), _BLOCK))
    shared = blocks.where(~F.col("alone"))
    which = "c0 boolean, c1 long, part int, n int"
    costs = cut(shared.select(*_WHICH, "transfer").groupBy(*CONV).applyInArrow(_scan_back, f"{which}, after array<long>, final boolean"))
    tried = shared.select(*_WHICH, "kinds").join(costs, _WHICH).mapInArrow(_try_starts, f"{which}, to array<long>, left array<long>")
    states = tried.groupBy(*CONV).applyInArrow(_scan_forward, f"{which}, state int, before long")
    alone = blocks.where("alone").withColumns({"after": F.array(*(F.lit(int(x)).cast("long") for x in AT_END)), "final": F.lit(True), "state": F.lit(0), "before": F.lit(0).cast("long")})
    known = alone.unionByName(shared.join(costs, _WHICH).join(states, _WHICH))
    edited = cut(known.drop("transfer", "alone").mapInArrow(lambda batches: _edit(batches, edit_schema), _EDITED))
    return Repaired(_summary(edited), _messages(edited, keyed))


def _conv_id():
    return F.when(F.col("c0"), F.col("c1")).alias("conv_id")


def _summary(edited: DataFrame) -> DataFrame:
    """Blocks put together: what lies across two neighbours is counted here."""
    blocks = edited.groupBy(*CONV).agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "cost")),
        F.min("t_least").alias("least"), F.max("t_most").alias("most"),
        F.array_sort(F.collect_list(F.struct("part", "n", "first", "last", "t_first", "t_last", "audit"))).alias("b"),
    )
    steps = F.when(F.size("b") > 1, F.sequence(F.lit(1), F.size("b") - 1)).otherwise(F.array().cast("array<int>"))
    across = lambda test: F.size(F.filter(steps, lambda i: test(F.get("b", i - 1), F.get("b", i))))
    illegal = across(lambda x, y: ~F.concat(x["last"], y["first"]).isin(*LEGAL))
    twice = across(lambda x, y: F.coalesce(x["t_last"] == y["t_first"], F.lit(False)))
    gaps = F.expr("try_cast(cast(most as decimal(20, 0)) - least + 1 as bigint)") - (F.col("turns") - twice)
    return blocks.select(
        _conv_id(), F.when(F.col("least").isNull(), F.lit(0)).otherwise(gaps).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
        (F.col("illegal") + illegal).alias("illegal"), "cost", F.array_join(F.transform("b", lambda x: x["audit"]), "").alias("audit"),
    )


def _messages(edited: DataFrame, keyed: DataFrame) -> DataFrame:
    """The messages left. Equal rows meet before the join, so each task sends one of a group of copies."""
    left = edited.select(*CONV, "before", F.posexplode(F.arrays_zip("t0", "t1", "h", "roles")).alias("at", "m")).select(*CONV, (F.col("before") + F.col("at")).alias("position"), "m.*")
    texts = keyed.groupBy(*CONV, *TURN, "h").agg(F.min("role").alias("own"), F.min("text").alias("text"))
    stay = left.where(F.col("h").isNotNull()).join(texts, [*CONV, *TURN, "h"]).select(_conv_id(), "position", F.coalesce("roles", "own").alias("role"), "text")
    return stay.unionByName(left.where(F.col("h").isNull()).select(_conv_id(), "position", F.col("roles").alias("role"), F.lit("").alias("text")))


def digests(messages: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its ``role:text``, newline-joined, by position.

    SHA-256 goes through a conversation in order, so one task reads it; as a stream, with one running hash at a time.
    """

    def run(batches):
        conv, running = (), None
        for batch in batches:
            done = []
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text"))):
                if (c,) != conv:
                    if running:
                        done.append((conv[0], running.hexdigest()))
                    conv, running = (c,), hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            if done:
                yield _digests(done)
        if running:
            yield _digests([(conv[0], running.hexdigest())])

    by = messages.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return by.mapInArrow(run, "conv_id long, repaired_sha256 string")


def _digests(pairs: list) -> pa.RecordBatch:
    ids, hashes = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes)], names=["conv_id", "repaired_sha256"])
