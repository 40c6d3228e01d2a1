"""Repair of conversations whose turns do not alternate: the cheapest edits, by a rank-compressed dynamic program.

A conversation is right if the initials of its roles give ``(s?(ua)+)?``. The
program runs over its rows. After each row there are four states (nothing yet,
after system, after user, after assistant), and an edit of one row is a macro: a
run of insertions, then Keep, Rerole or Delete. The macros' strings (D, ID, K,
IK, ...) are a prefix-free code, so that of two audits that have consumed the
same rows none begins the other, and the first macro in which they differ
decides. The program therefore never holds an audit: a layer has for each state
its cost and the rank of its audit among the states, the next layer's order is
that of (rank of the parent, macro), and the audit is read off the parent
pointers afterwards. A layer depends only on the last one's costs less their
minimum, its ranks and the row's kind, which are few, so each step is looked up.

Layers compose: a block of rows is summed up by the costs and ranks from each
state to each state. Long conversations are cut into blocks, which are summed up
where they lie; their sums are chained, and each block is then read off between
the two states that the chain went through.
"""

import functools
import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pricewave.llm.common import BLANKS, cut, partitions, stored

#: States: nothing yet, after a system, user, assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after one inserted or reroled turn, and the role that it has.
NEXT, ROLE = (USER, USER, ASSISTANT, USER), {USER: "user", ASSISTANT: "assistant"}
#: Where a kept row leads, by state and initial.
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Insertions that a state needs to be an end.
TAIL = (0, 2, 1, 0)
INSERT_COST, REROLE_COST, DELETE_COST, CUT_COST = 3, 3, 4, 3
#: Insertions and edit of each macro, in the order of their strings. A third insertion would lead back to the state after the first.
MACROS = sorted(((k, e) for k in range(3) for e in "DKR"), key=lambda m: "I" * m[0] + m[1])
#: Rows and characters of a block, which one task holds.
BLOCK_ROWS, BLOCK_CHARS = 4096, 8 << 20

TURNS = "array<struct<role:string,text:string>>"
REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults that a hash of conv_id and turn chooses.

    crc32 of ``conv_id:turn`` modulo 20 drops a row (0), empties its text (1),
    removes its ``[.!?]`` (2), repeats it (3) or sets its role to user (4). A
    null role, text or part of the hash's key counts as one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"))
    rows = rows.withColumn("fault", F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


@functools.lru_cache(maxsize=1 << 16)
def step(layer: tuple, kind: tuple) -> tuple:
    """(layer after a row, least cost taken out of it, parent pointers: the state and the macro for each state).

    layer: (cost, rank of the audit) or None for each state. kind: the role's
    initial, whether the row must go, whether it is cut off. A state is left out
    once every way on from it is dearer than the same from another: from
    ``after assistant`` all can be done that can be done from the first two
    states, but for keeping a system row, which is deleted instead.
    """
    initial, must, cut_off = kind
    best: dict[int, tuple] = {}
    for state, entry in enumerate(layer):
        for order, (inserts, edit) in enumerate(MACROS if entry else ()):
            at = state
            for _ in range(inserts):
                at = NEXT[at]
            price = INSERT_COST * inserts
            if edit == "D":
                to, price = at, price + DELETE_COST
            elif must or (edit == "K" and (at, initial) not in KEEP):
                continue
            elif edit == "K":
                to, price = KEEP[at, initial], price + CUT_COST * cut_off
            else:
                to, price = NEXT[at], price + REROLE_COST + CUT_COST * cut_off
            found = (entry[0] + price, entry[1], order, state)
            if to not in best or found < best[to]:
                best[to] = found
    later = min((best[s][0] + INSERT_COST * TAIL[s] for s in (USER, ASSISTANT) if s in best), default=None)
    if later is not None:
        for state, more in ((START, DELETE_COST), (SYSTEM, 0)):
            if state in best and best[state][0] > later + more:
                del best[state]
    low = min(f[0] for f in best.values())
    rank = {s: k for k, s in enumerate(sorted(best, key=lambda s: best[s][1:3]))}
    there = [best.get(s) for s in range(4)]
    return (
        tuple(f and (f[0] - low, rank[s]) for s, f in enumerate(there)),
        low,
        tuple(f and (f[3], f[2]) for f in there),
    )


def entry(state: int = START) -> tuple:
    return tuple((0, 0) if s == state else None for s in range(4))


def forward(kinds, layer: tuple) -> tuple:
    """(last layer, cost taken out of it, parent pointers of each row)."""
    total, back = 0, []
    for kind in kinds:
        layer, low, pointers = step(layer, kind)
        total += low
        back.append(pointers)
    return layer, total, back


def end_state(layer: tuple) -> int:
    """The state in which the cheapest audit, the least of them in ASCII order, ends."""
    return min((e[0] + INSERT_COST * TAIL[s], e[1], s) for s, e in enumerate(layer) if e)[2]


def edits(back: list, state: int) -> list[tuple]:
    """The macros that lead to a state of the last layer."""
    found = []
    for pointers in reversed(back):
        state, order = pointers[state]
        found.append(MACROS[order])
    return found[::-1]


def apply(rows: list, macros: list[tuple], state: int, tail: int) -> tuple[str, list[dict]]:
    """(audit, repaired turns) of rows (role, text) from a state on, with insertions at the end."""
    audit, out = [], []
    for row, (inserts, edit) in zip([*rows, None], [*macros, (tail, "")]):
        for _ in range(inserts):
            state = NEXT[state]
            out.append({"role": ROLE[state], "text": ""})
        audit.append("I" * inserts + edit)
        if edit == "K":
            state = KEEP[state, row[0][:1]]
            out.append({"role": row[0], "text": row[1]})
        elif edit == "R":
            state = NEXT[state]
            out.append({"role": ROLE[state], "text": row[1]})
    return "".join(audit), out


def _kind(role: str, text: str, again: bool) -> tuple[tuple, int]:
    """(kind, fault) of a row: the first of blank (1), duplicate (2) and truncated (3) counts."""
    bare = text.rstrip(BLANKS)
    fault = 1 if not bare else 2 if again else 3 if bare[-1] not in ".!?" else 0
    return (role[:1] if role[:1] in ("s", "u", "a") else "", fault in (1, 2), fault == 3), fault


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _solve(rows: list) -> dict:
    """The report on one conversation's rows (turn, role, text) in order, its audit and its repaired turns."""
    seen, kinds, faults = set(), [], [0, 0, 0, 0]
    for _, role, text in rows:
        kind, fault = _kind(role, text, (role, text) in seen)
        seen.add((role, text))
        kinds.append(kind)
        faults[fault] += 1
    layer, cost, back = forward(kinds, entry())
    last = end_state(layer)
    audit, turns = apply([r[1:] for r in rows], edits(back, last), START, TAIL[last])
    numbers = {r[0] for r in rows if r[0] is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    counts = (gaps, *faults[1:], _illegal([r[1][:1] for r in rows]), cost + layer[last][0] + INSERT_COST * TAIL[last])
    return dict(zip(REPORT, counts)) | {"audit": audit, "turns": turns}


def _whole(names: list[str], block_rows: int, block_chars: int):
    """Solve the conversations of a sorted partition; those at its edges may go on elsewhere, and those above a block are left open."""

    def run(batches):
        schema = None
        first, key, held, chars, waiting = True, object(), [], 0, None

        def close():
            big = held is None
            found = {"gaps": None, "audit": None, "turns": None} if big else _solve(held)
            return {"conv_id": key, "edge": first, "big": big, **{c: found.get(c) for c in (*REPORT, "audit", "turns")}}

        def batch_of(rows):
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            if schema is None:
                turn = pa.struct([("role", pa.string()), ("text", pa.string())])
                kinds = [pa.field("conv_id", batch.schema.field("conv_id").type), pa.field("edge", pa.bool_()), pa.field("big", pa.bool_())]
                schema = pa.schema([*kinds, *[pa.field(c, pa.int64()) for c in REPORT], pa.field("audit", pa.string()), pa.field("turns", pa.list_(turn))])
            out = []
            for conv, number, role, text in zip(*(batch.column(c).to_pylist() for c in names)):
                if conv != key or waiting is None:
                    if waiting is not None:
                        out.append(close())
                        first = False
                    key, held, chars, waiting = conv, [], 0, True
                if held is not None:
                    chars += len(text) + 64
                    held.append((number, role, text))
                    if len(held) > block_rows or chars > block_chars:
                        held = None
            if out:
                yield batch_of(out)
        if waiting is not None:
            yield batch_of([close() | {"edge": True}])

    return run


def _stamp(names: list[str], block_rows: int, block_chars: int):
    """Add to the rows of a sorted partition its number, that of the block within it, the place in the block and whether the row repeats the last."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        block, place, chars, last = -1, 0, 0, None
        for batch in batches:
            marks = []
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                if last is None or row[0] != last[0] or place >= block_rows or chars > block_chars:
                    block, place, chars = block + 1, 0, 0
                marks.append((part, block, place, last == row))
                place, chars, last = place + 1, chars + len(row[3]) + 64, row
            marks = [pa.array(c) for c in zip(*marks)] or [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *marks], names=[*batch.schema.names, "part", "block", "place", "same"])

    return run


def _block_kinds(rows: pd.DataFrame) -> list[tuple]:
    return [_kind(role, text, again) for role, text, again in zip(rows["role"], rows["text"], rows["again"])]


def _sum_up(rows: pd.DataFrame) -> pd.DataFrame:
    """A block's costs and ranks from each state to each state, -1 where there is no way, and what it has for the report."""
    rows = rows.sort_values("place")
    kinds = _block_kinds(rows)
    faults = [f for _, f in kinds]
    initials = [r[:1] for r in rows["role"]]
    costs, ranks = [], []
    for state in range(4):
        layer, total, _ = forward([k for k, _ in kinds], entry(state))
        costs += [e[0] + total if e else -1 for e in layer]
        ranks += [e[1] if e else -1 for e in layer]
    head = rows.iloc[:1][["conv_id", "part", "block"]].reset_index(drop=True)
    return head.assign(
        costs=[costs], ranks=[ranks], blank=faults.count(1), duplicate=faults.count(2), truncated=faults.count(3),
        illegal=_illegal(initials), first=initials[0], last=initials[-1],
    )


def _chain(blocks: pd.DataFrame) -> pd.DataFrame:
    """The states between a conversation's blocks on its cheapest way, and its report."""
    blocks = blocks.sort_values(["part", "block"]).reset_index(drop=True)
    layer, back = entry(), []
    for costs, ranks in zip(blocks["costs"], blocks["ranks"]):
        best: dict[int, tuple] = {}
        for state, here in enumerate(layer):
            for to in range(4) if here else ():
                k = 4 * state + to
                if costs[k] >= 0:
                    found = (here[0] + int(costs[k]), here[1], int(ranks[k]), state)
                    if to not in best or found < best[to]:
                        best[to] = found
        rank = {s: k for k, s in enumerate(sorted(best, key=lambda s: best[s][1:3]))}
        layer = tuple((best[s][0], rank[s]) if s in best else None for s in range(4))
        back.append({s: f[3] for s, f in best.items()})
    state = last = end_state(layer)
    ways = []
    for pointers in reversed(back):
        ways.append((pointers[state], state))
        state = pointers[state]
    ways.reverse()
    joints = _illegal_joints(list(blocks["first"]), list(blocks["last"]))
    n = len(blocks)
    return blocks[["conv_id", "part", "block"]].assign(
        entry=[a for a, _ in ways], exit=[b for _, b in ways], tail=[0] * (n - 1) + [TAIL[last]], piece=range(n), pieces=n,
        blank=blocks["blank"].sum(), duplicate=blocks["duplicate"].sum(), truncated=blocks["truncated"].sum(),
        illegal=blocks["illegal"].sum() + joints, cost=layer[last][0] + INSERT_COST * TAIL[last],
    )


def _illegal_joints(first: list[str], last: list[str]) -> int:
    return sum(_illegal([a, b]) for a, b in zip(last, first[1:]))


def _read_off(rows: pd.DataFrame) -> pd.DataFrame:
    """A block's part of the audit and its repaired turns, between the states that the chain went through."""
    rows = rows.sort_values("place")
    one = rows.iloc[0]
    _, _, back = forward([k for k, _ in _block_kinds(rows)], entry(int(one["entry"])))
    audit, turns = apply(list(zip(rows["role"], rows["text"])), edits(back, int(one["exit"])), int(one["entry"]), int(one["tail"]))
    return rows.iloc[:1][["conv_id", "piece", "pieces", "blank", "duplicate", "truncated", "illegal", "cost"]].assign(audit=audit, turns=[turns])


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    return functools.reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[n]) for n in names])


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows in order over the partitions; what is sampled for the ranges holds the texts' beginnings only."""
    ranges = rows.repartitionByRange(partitions(rows), "conv_id", "turn", "role", F.left("text", F.lit(32)))
    return ranges.sortWithinPartitions("conv_id", "turn", "role", "text")


def _long(rows: DataFrame, keys: DataFrame, block_rows: int, block_chars: int) -> DataFrame:
    """The pieces of the conversations named by keys, each conversation being chained from its blocks."""
    rows = rows.join(keys, _same(rows, keys, "conv_id"), "left_semi")
    kind = rows.schema["conv_id"].dataType.simpleString()
    marked = "conv_id {0}, turn long, role string, text string, part long, block long, place long, same boolean".format(kind)
    dealt = _dealt(rows)
    stamped = stored(dealt.mapInArrow(_stamp(dealt.columns, block_rows, block_chars), marked).withColumns({"h": F.xxhash64("role", "text"), "g": F.xxhash64(F.lit(1), "role", "text")}))
    # A row is a duplicate if its role and text have an earlier turn, or follow themselves within one; turns without a number are the earliest.
    early = F.coalesce(F.col("turn"), F.lit(-(1 << 63)))
    firsts = cut(stamped.groupBy("conv_id", "h", "g").agg(F.min(early).alias("early"), F.count("*").alias("n")).where("n > 1").drop("n"))
    faulty = stamped.join(firsts, _same(stamped, firsts, "conv_id", "h", "g"), "left")
    again = F.col("same") | (F.col("early").isNotNull() & (early > F.col("early")))
    ready = faulty.select(stamped["conv_id"], "role", "text", "part", "block", "place", F.coalesce(again, F.lit(False)).alias("again"))
    parts = f"conv_id {kind}, part long, block long"
    sums = f"{parts}, costs array<long>, ranks array<long>, blank long, duplicate long, truncated long, illegal long, first string, last string"
    ways = f"{parts}, entry long, exit long, tail long, piece long, pieces long, blank long, duplicate long, truncated long, illegal long, cost long"
    chained = cut(ready.groupBy("conv_id", "part", "block").applyInPandas(_sum_up, sums).groupBy("conv_id").applyInPandas(_chain, ways))
    numbers = stamped.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    met = ready.join(chained.drop("conv_id"), ["part", "block"])
    out = f"conv_id {kind}, piece long, pieces long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, turns {TURNS}"
    found = met.groupBy("part", "block").applyInPandas(_read_off, out)
    return found.join(numbers, _same(found, numbers, "conv_id")).select(
        found["conv_id"], "piece", "pieces", F.coalesce("gaps", F.lit(0)).alias("gaps"), *REPORT[1:], "audit", "turns"
    )


def repair(turns: DataFrame, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Conversations with the cheapest edits that make their roles alternate.

    Input: conv_id, turn, role, text; a null role or text counts as one space.
    Rows are taken by turn, null turns first, equal turns by role and text. Each
    row's first fault counts: blank, duplicate (role and text seen earlier in the
    conversation), truncated (the last character that is not white space is none
    of ``.!?``). Keep costs 0, Rerole 3, Delete 4 (blank and duplicate rows must
    go), Insert 3, and a truncated row that stays 3 more. An empty role has no initial and can't be kept. Of equally cheap audits
    the least in ASCII order is taken.

    Output: conv_id, piece, pieces, gaps, blank, duplicate, truncated, illegal,
    cost, audit, turns (the repaired role and text). A conversation is one row; one of more than
    block_rows rows or block_chars characters, or one that two partitions share,
    has several pieces in order, each with its part of audit and turns and all
    with the whole report. Rows with a null conv_id are one conversation.
    Conversations without rows do not appear. An empty table gives no rows.

    Rows are dealt by ranges of conv_id, turn, role and text, so that a long
    conversation is spread over tasks; no task holds more than a block of one.
    Equal rows of one turn stay together.
    """
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = _dealt(rows)
    out = f"conv_id {kind}, edge boolean, big boolean, {', '.join(f'{c} long' for c in REPORT)}, audit string, turns {TURNS}"
    found = stored(dealt.mapInArrow(_whole(dealt.columns, block_rows, block_chars), out))
    open_ = cut(found.where("edge OR big").groupBy("conv_id").agg(F.count("*").alias("n"), F.max("big").alias("big")).where("big OR n > 1").select("conv_id"))
    whole = found.join(open_, _same(found, open_, "conv_id"), "left_anti")
    done = whole.select("conv_id", F.lit(0).cast("long").alias("piece"), F.lit(1).cast("long").alias("pieces"), *REPORT, "audit", "turns")
    return done.unionByName(_long(rows, open_, block_rows, block_chars))


def _hash_pieces(names: list[str]):
    """Chain the pieces of each conversation of a sorted partition."""

    def run(batches):
        key, state, audit, report = None, None, [], None

        def close():
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([*report, "".join(audit), state.hexdigest()], kinds)], names=[*names[:7], "audit", "repaired_sha256"])

        for batch in batches:
            kinds = [*batch.schema.types[:7], pa.string(), pa.string()]
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                if report is None or row[0] != key:
                    if report is not None:
                        yield close()
                    key, state, audit, report, some = row[0], hashlib.sha256(), [], row[:7], False
                audit.append(row[8])
                for turn in row[9]:
                    state.update((("\n" if some else "") + turn["role"] + ":" + turn["text"]).encode("utf-8", "surrogatepass"))
                    some = True
        if report is not None:
            yield close()

    return run


def digests(repaired: DataFrame) -> DataFrame:
    """One row for each conversation of repair(): conv_id, the report, audit, repaired_sha256 over ``role:text`` joined by newlines.

    A conversation of several pieces is hashed piece by piece in one task, since SHA-256 takes its input in order; nothing of it but the audit is held.
    """
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    one = repaired.where("pieces = 1").select("conv_id", *REPORT, "audit", F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))
    many = repaired.where("pieces > 1").select("conv_id", *REPORT, "piece", "audit", "turns")
    kinds = f"conv_id {repaired.schema['conv_id'].dataType.simpleString()}, {', '.join(f'{c} long' for c in REPORT)}, audit string, repaired_sha256 string"
    sorted_ = many.repartition(partitions(many), "conv_id").sortWithinPartitions("conv_id", "piece")
    return one.unionByName(sorted_.mapInArrow(_hash_pieces(many.columns), kinds))
