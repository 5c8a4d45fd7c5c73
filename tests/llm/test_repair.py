import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from tallygrid.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(turns):
    """(cost, audit, repaired) over all series of edits with few insertions, none of them left out."""
    told = faults(turns)
    best = None
    options = [[("D", 3, None)] if f in ("blank", "duplicate") else
               [("D", 3, None), ("K", int(f == "truncated"), (role, text)), *(("R", 2 + int(f == "truncated"), (new, text)) for new in ("user", "assistant"))]
               for (role, text), f in zip(turns, told)]
    for chosen in itertools.product(*options):
        # Insertions: at each place none, one or two turns.
        fills = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
        for holes in itertools.product(fills, repeat=len(turns) + 1):
            if sum(map(len, holes)) > 3:
                continue
            out, audit, cost = [], "", 0
            for hole, edit in itertools.zip_longest(holes, chosen):
                for role in hole:
                    out.append((role, ""))
                    audit, cost = audit + "I", cost + 2
                if edit:
                    audit, cost = audit + edit[0], cost + edit[1]
                    out += [edit[2]] if edit[2] else []
            if LEGAL.match("".join(r[:1] or "?" for r, _ in out)):
                best = min(best or (cost, audit, out), (cost, audit, out))
    return best


def expected(rows):
    turns = [(r, t) for _, r, t in rows]
    numbers = {n for n, _, _ in rows if n is not None}
    told = faults(turns)
    cost, audit, out = cheapest(turns)
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        **{f: told.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(turns)),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }


def test_cheapest_edits_of_many_conversations(spark):
    draw = random.Random(5)
    rows = {}
    for conv in range(250):
        roles, texts = ["user", "user", "assistant", "assistant", "system", "tool", "ux", ""], ["Yes.", "No", " ", "", "Why? ", "é!"]
        rows[conv] = sorted((draw.choice([-1, 0, 1, 2, 5, 9]), draw.choice(roles), draw.choice(texts)) for _ in range(draw.randint(1, 4)))
    frame = spark.createDataFrame([(c, *r) for c, rs in rows.items() for r in rs], SCHEMA)
    got = {r.conv_id: r.asDict() for r in repair.repair_digests(frame).collect()}
    assert len(got) == len(rows)
    for c, rs in rows.items():
        mine = got[c]
        mine.pop("conv_id")
        assert mine == expected(rs), rs


def test_repaired_turns_are_legal_and_real(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi!"), (1, 1, "user", "Hi!"), (1, 4, "user", "And?"), (2, 0, "system", "Be brief.")]
    got = repair.repaired_turns(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "turn").collect()
    roles = {}
    for r in got:
        roles.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    assert all(LEGAL.match("".join(x[1][:1] for x in v)) and [x[0] for x in v] == list(range(len(v))) for v in roles.values())


def test_nulls_extra_columns_and_long_texts(spark):
    rows = [(None, None, None, None, 1), (None, 3, "user", "x" * 300_000 + "?", 2), (7, None, "assistant", None, 3), (7, None, "assistant", " ", 4)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, fault int")
    got = {r.conv_id: r for r in repair.repair_digests(frame).collect()}
    assert (got[None].blank, got[None].gaps, got[None].illegal, got[None].audit) == (1, 0, 1, "DKI")
    assert (got[7].blank, got[7].gaps, got[7].audit, got[7].cost) == (2, 0, "DD", 6)
    wide = spark.createDataFrame([(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")], SCHEMA)
    assert repair.repair_digests(wide).first().gaps == 2**63 - 1


def test_long_conversation_over_many_batches(spark):
    n = 5000
    rows = spark.range(n).selectExpr("1L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('Turn ', id, '.') text")
    got = repair.repair_digests(rows).first()
    said = "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:Turn {i}." for i in range(n))
    assert (got.audit, got.cost, got.repaired_sha256) == ("K" * n, 0, hashlib.sha256(said.encode()).hexdigest())


def test_damage(spark):
    rows = [(c, t, "assistant", f"a.{c}!{t}?") for c in range(20) for t in range(10)] + [(None, None, None, None)]
    want = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        if k:
            want += [(c, t, "user" if k == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(k, text))] * (2 if k == 3 else 1)
    got = [tuple(r) for r in repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_empty_and_all_dropped(spark):
    assert repair.repair_damaged(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repair.repair_damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)).first()
    assert tuple(got) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_equals_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    got = {r.conv_id: r.asDict() for r in queries.QUERIES["op13_conversation_repair"](spark, d).collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    out = con.sql(queries.ORACLES["op13_conversation_repair"])
    want = [dict(zip(out.columns, row)) for row in out.fetchall()]
    assert len(want) == len(got)
    for w in want:
        assert got[w["conv_id"]] == w
