import random

from tallygrid.llm import linededup as L


def words(*n):
    draw = random.Random(sum(n) + len(n))
    return [" ".join(f"w{draw.randrange(10**6)}" for _ in range(k)) for k in n]


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, tag int").repartition(3)
    out = L.drop_passages(docs)
    assert out.columns == docs.columns
    return sorted(((r.doc_id is None, r.doc_id or 0, r.tag, r.text) for r in out.collect()), key=str)


def brute(rows):
    """Lines of each text that lie in a run of 50 words or more that an earlier text has."""
    out = {}
    for d, t, tag in rows:
        lines, gone = t.split("\n"), set()
        for e, u, _ in rows:
            if e < d:
                other = "\n" + u + "\n"
                for a in range(len(lines)):
                    for b in range(a + 1, len(lines) + 1):
                        part = "\n".join(lines[a:b])
                        if len(part.split()) >= 50 and "\n" + part + "\n" in other:
                            gone.update(range(a, b))
        out[tag] = {x for i, x in enumerate(lines) if i not in gone}
    return out


def test_every_line_of_a_short_line_passage_goes(spark):
    for sizes in ((43, 49), (30, 5, 30), (5,) * 14, (49, 2), (20, 0, 20, 0, 20), (3, 48, 3)):
        part = words(*sizes)
        rows = [(i, "\n".join([f"before {i} {sizes}", *part, f"after {i}"]), i) for i in range(1, 5)]
        got = {tag: t for _, _, tag, t in run(spark, rows)}
        assert got[1] == rows[0][1]
        assert all(got[i].split("\n") == [f"before {i} {sizes}", f"after {i}"] for i in (2, 3, 4)), sizes


def test_against_brute_force(spark):
    draw, pool = random.Random(3), words(*(random.Random(4).randint(1, 45) for _ in range(60)))
    rows = []
    for i in range(40):
        parts = [f"only {i}"]
        for _ in range(3):
            a = draw.randrange(50)
            parts += pool[a : a + draw.randint(1, 8)] + [f"own {i} {draw.random()}"]
        rows.append((i, "\n".join(parts), i))
    want = brute(rows)
    chunked = {r.tag: r.text.split("\n") for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, tag int")).collect()}
    for _, _, tag, text in run(spark, rows):
        # What the chunks remove goes too; nothing of the runs stays; what is its own stays.
        assert set(text.split("\n")) <= want[tag] and set(text.split("\n")) <= set(chunked[tag])
        assert {x for x in want[tag] if x.startswith("o")} <= set(text.split("\n"))


def test_each_line_stays_once_and_own_repeats_go(spark):
    part = "\n".join(words(30, 30, 7))
    got = {tag: t for _, _, tag, t in run(spark, [(1, f"{part}\nmid\n{part}", 1), (2, "x\n" * 400, 2), (3, None, 3), (4, "", 4)])}
    assert got[1] == f"{part}\nmid" and got[3] is None and got[4] == ""
    assert "x" in got[2].split("\n") and len(got[2]) < 200


def test_rows_without_id_are_documents_of_their_own(spark):
    part = "\n".join(words(30, 30, 8))
    rows = [(None, f"a\n{part}", 1), (None, f"b\n{part}", 2), (None, f"c\n{part}", 3), (None, "lone", 4)]
    got = {tag: t for _, _, tag, t in run(spark, rows)}
    assert sum(part in t for t in got.values()) == 1 and got[4] == "lone"
    assert sorted(t for t in got.values() if part not in t) == sorted(x for x in ("a", "b", "c", "lone") if f"{x}\n{part}" not in got.values())
    rows.append((9, f"d\n{part}", 5))
    got = {tag: t for _, _, tag, t in run(spark, rows)}
    assert got == {1: "a", 2: "b", 3: "c", 4: "lone", 5: f"d\n{part}"}
