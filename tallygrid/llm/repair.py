"""Conversation structure repair: the cheapest edits that bring the turns into a legal order.

The roles of a repaired conversation have the initials `(s?(ua)+)?`. A machine of four states
reads them: nothing yet, after `s`, after `u`, after `a`; it may end with nothing or after `a`.
Turns are first read backward: a turn's cost to go is, for each state, the least cost of all that
is still to come. They are then read forward, and at each turn the least letter among the
edits that keep to that cost is taken. Both passes hold one turn at a time.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, small_batches

#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States of the machine, and what may follow each: initial -> state.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The role that an insertion or a new role can have in each state.
GIVEN = ("user", "user", "assistant", "user")
#: Cost to go at the end of a conversation, by state.
AT_END = (0, 2 * INSERT, INSERT, 0)
#: Adjacent initials that are legal.
PAIRS = ("su", "ua", "au")
#: White space: a text of nothing else is blank.
WHITE = " \t\n\x0b\x0c\r"
_TURN = "conv_id long, turn long, role string, text string, fault string"
EDITS = f"{_TURN}, illegal boolean, edit string, step long, new_role string, new_text string, cost long"
DIGESTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
#: Rows handed on at once.
_ROWS = 1000


def with_faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, fault (blank, duplicate, truncated, or null; the first that holds) and seen: how
    many turns up to this one have its role and text, which tells equal rows apart.

    Blank: no character but white space. Duplicate: a turn before has the same role and text. Truncated:
    the last character other than white space is none of `.!?`. Null roles and texts are one space.
    """
    told = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    ).repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    bare = F.rtrim("text", F.lit(WHITE))
    return told.withColumn("seen", seen).select(
        "conv_id", "turn", "role", "text",
        F.when(bare == "", "blank").when(F.col("seen") > 1, "duplicate").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").alias("fault"), F.col("seen").cast("long"),
    )


def _backward(role: str, fault: str | None, to_go: tuple[int, ...]) -> tuple[tuple[int, ...], str]:
    """Costs to go before a turn, from those after it, and for each state the edits up to this turn and the state then."""
    stays = fault not in ("blank", "duplicate")
    extra = TRUNCATED * (fault == "truncated")
    initial = role[:1]
    best: list[int] = []
    for state in range(4):
        found = [DELETE + to_go[state]]
        if stays:
            if initial in NEXT[state]:
                found.append(extra + to_go[NEXT[state][initial]])
            found.append(REROLE + extra + to_go[NEXT[state][GIVEN[state][0]]])
        best.append(min(found))
    # One insertion leads from user to assistant and back, so two of them are enough.
    given = [NEXT[state][GIVEN[state][0]] for state in range(4)]
    for _ in range(2):
        best = [min(best[state], INSERT + best[given[state]]) for state in range(4)]
    plans = []
    for begin in range(4):
        state, edits = begin, ""
        while True:
            now = best[state]
            if DELETE + to_go[state] == now:
                edits += "D"
            elif INSERT + best[given[state]] == now:
                edits, state = edits + "I", given[state]
                continue
            elif initial in NEXT[state] and extra + to_go[NEXT[state][initial]] == now:
                edits, state = edits + "K", NEXT[state][initial]
            else:
                edits, state = edits + "R", given[state]
            break
        plans.append(f"{edits}{state}")
    return tuple(best), ",".join(plans)


def _read_backward(batches):
    """Adds the plans and the cost to go from nothing; batches come in descending order within a conversation."""
    conv, to_go, begun = None, AT_END, False
    for batch in batches:
        plans, costs = [], []
        for c, role, fault in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "fault"))):
            if not begun or c != conv:
                conv, to_go, begun = c, AT_END, True
            to_go, plan = _backward(role, fault, to_go)
            plans.append(plan)
            costs.append(to_go[NOTHING])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(plans, pa.string()), pa.array(costs, pa.int64())], names=[*batch.schema.names, "plans", "cost"])


def _read_forward(batches):
    """Edits in order; batches come in ascending order within a conversation."""
    names = [x.split()[0] for x in EDITS.split(", ")]
    types = dict(zip(names, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())))
    held: list[tuple] = []
    size, conv, state, step, before, cost, begun = 0, None, NOTHING, 0, None, 0, False

    def flush():
        columns = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(c, types[n]) for n, c in zip(names, columns)], names=names)

    def inserted():
        nonlocal state, step
        role = GIVEN[state]
        held.append((conv, None, None, None, None, False, "I", step, role, "", cost))
        state, step = NEXT[state][role[0]], step + 1

    def ended():
        while begun and AT_END[state]:
            inserted()

    for batch in batches:
        for c, turn, role, text, fault, plans, to_go in zip(*(x.to_pylist() for x in batch.columns)):
            if not begun or c != conv:
                ended()
                conv, state, step, before, cost, begun = c, NOTHING, 0, None, to_go, True
            plan = plans.split(",")[state]
            for _ in plan[:-2]:
                inserted()
            edit, state_then = plan[-2], int(plan[-1])
            new_role = {"D": None, "K": role, "R": GIVEN[state]}[edit]
            illegal = before is not None and before + role[:1] not in PAIRS
            held.append((c, turn, role, text, fault, illegal, edit, step, new_role, None if edit == "D" else text, cost))
            state, step, before, size = state_then, step + 1, role[:1], size + len(text)
            if len(held) >= _ROWS or size > 8 << 20:
                yield flush()
                held, size = [], 0
    ended()
    if held:
        yield flush()


def repair_edits(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) to the edits that repair each conversation, in order of (conv_id, step).

    Per edit: the turn it is about with its fault, whether the initials of its role and of the one before are
    illegal, edit (K keep, R new role, D delete, I insert), step from 0, new_role and new_text (null if
    deleted), and cost, that of the whole conversation. Blank and duplicate turns are deleted (3), a
    new role costs 2, an inserted empty turn 2, a truncated turn that stays 1. Of the cheapest series of edits
    it is the one whose letters are least in ASCII.

    Turns come in order of their number, null first; those of equal number in order of role, then text.
    Null roles and texts are one space. Null conv_ids form one conversation. Repeated rows are turns
    of their own, of which the later ones are duplicates. A role that begins with another letter
    than s, u or a gets a new one or goes. Columns other than the four are ignored; an empty
    table gives an empty result. A conversation is read as a stream by one task.
    """
    small_batches(rows.sparkSession)
    down = with_faults(rows).sortWithinPartitions(F.col("conv_id"), F.col("turn").desc_nulls_last(), F.desc("role"), F.desc("text"), F.desc("seen"))
    planned = down.mapInArrow(_read_backward, f"{_TURN}, seen long, plans string, cost long")
    up = planned.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text", "seen")
    return up.drop("seen").mapInArrow(_read_forward, EDITS)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, turn from 0 without a gap, role, text. Handles rows as `repair_edits`."""
    kept = repair_edits(rows).where("edit <> 'D'")
    turn = F.row_number().over(Window.partitionBy("conv_id").orderBy("step")) - 1
    return kept.select("conv_id", turn.cast("long").alias("turn"), F.col("new_role").alias("role"), F.col("new_text").alias("text"))


def _digest(batches):
    names = [x.split()[0] for x in DIGESTS.split(", ")]
    done: list[tuple] = []
    conv, now = None, None

    def closed():
        gaps = 0 if now["least"] is None else min(now["most"] - now["least"] + 1 - now["turns"], 2**63 - 1)
        done.append((conv, gaps, now["blank"], now["duplicate"], now["truncated"], now["illegal"], now["cost"], "".join(now["audit"]), now["sha"].hexdigest()))

    def sent():
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n, c in zip(names, zip(*done))], names=names)

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "fault", "illegal", "edit", "new_role", "new_text", "cost")]
        for c, turn, fault, illegal, edit, role, text, cost in zip(*columns):
            if now is None or c != conv:
                if now is not None:
                    closed()
                conv = c
                now = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": cost, "audit": [], "sha": hashlib.sha256(), "first": True, "least": None, "most": None, "turns": 0}
            if fault:
                now[fault] += 1
            now["illegal"] += illegal
            now["audit"].append(edit)
            if turn is not None and turn != now["most"]:
                now["least"], now["most"], now["turns"] = turn if now["least"] is None else now["least"], turn, now["turns"] + 1
            if edit != "D":
                now["sha"].update(("" if now["first"] else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                now["first"] = False
        if len(done) >= _ROWS:
            yield sent()
            done = []
    if now is not None:
        closed()
    if done:
        yield sent()


def repair_digests(rows: DataFrame) -> DataFrame:
    """One row per conversation: gaps, counts of faults and of illegal neighbours, cost, audit (the letters of the
    edits) and repaired_sha256, over the repaired turns as `role:text` joined by line breaks.

    gaps: turn numbers that are missing between the first and the last, null ones aside; 0 if all are null.
    Rows are handled as by `repair_edits`, whose edits this reads where they are, without a shuffle.
    """
    return repair_edits(rows).mapInArrow(_digest, DIGESTS)


def damaged(rows: DataFrame) -> DataFrame:
    """Faults put into conversations by a checksum of `conv_id:turn` modulo 20.

    0 drops a row, 1 empties its text, 2 takes `.`, `!` and `?` out of it, 3 repeats the row, 4 sets the role
    user. Nulls in role and text are one space, and so they are in the checksummed string.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    (k,) = fresh(rows.select("conv_id", "turn", "role", "text"), "kind")
    text = F.when(F.col(k) == 1, "").when(F.col(k) == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    kept = rows.withColumn(k, kind).where(F.col(k) != 0)
    return kept.withColumn(k, F.explode(F.when(F.col(k) == 3, F.array(k, k)).otherwise(F.array(k)))).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(F.col(k) == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"),
    )


def repair_damaged(rows: DataFrame) -> DataFrame:
    """`repair_digests` of the damaged rows, for every conv_id of the rows; where no row is left, zeros and the digest of nothing."""
    found = repair_digests(damaged(rows)).withColumnRenamed("conv_id", "found_id")
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    rest = [c.split()[0] for c in DIGESTS.split(", ")][1:]

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(nothing[name]) if name in nothing else F.lit(0).cast("long")).alias(name)

    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select("conv_id", *map(filled, rest))
