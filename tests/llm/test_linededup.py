import hashlib
import random

from tallygrid.llm import linededup as L

PASSAGE = "\n".join(f"shared line number {i} of a licence" for i in range(12))
LONG = " ".join(f"w{i}" for i in range(55))


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, n_removed int").repartition(3)
    out = L.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "n_removed"]
    return sorted(((r.doc_id is None, r.doc_id or 0, r.text or "", r.text is None, r.n_removed) for r in out.collect()))


def ranges(text):
    """Chunks of several lines, and the shortest runs of 50 words from and to each line, written out."""
    lines = text.split("\n")
    number = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    out, a = set(), 0
    for i in range(len(lines)):
        if i + 1 == len(lines) or i and (number[i - 1] * 1_000_003 + number[i]) % (2**31 - 1) % 3 == 0:
            if i > a and "\n".join(lines[a : i + 1]).split():
                out.add((a, i + 1))
            a = i + 1
    big = lambda a, b: len(" ".join(lines[a:b]).split()) >= 50
    for i in range(len(lines)):
        out |= {(i, b) for b in range(i + 1, len(lines) + 1) if big(i, b) and not big(i, b - 1)}
        out |= {(a, i + 1) for a in range(i + 1) if big(a, i + 1) and not big(a + 1, i + 1)}
    return lines, out


def brute(rows):
    """By the bytes themselves. Rows have different texts or doc_ids; those without doc_id share no passage here."""
    first, parts = {}, {}
    for d, t in rows:
        if t is None:
            continue
        lines, found = parts[d, t] = ranges(t)
        for a, b in found:
            k = "\n".join(lines[a:b])
            at = (d is None, d or 0, a, b)
            first[k] = min(first.get(k, at), at)
    out = []
    for d, t in rows:
        gone = set()
        if t is not None:
            lines, found = parts[d, t]
            for a, b in found:
                nul, e, _, stop = first["\n".join(lines[a:b])]
                if (nul, e) < (d is None, d or 0) or (nul, e) == (d is None, d or 0) and stop <= a:
                    gone.update(range(a, b))
            t = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((d is None, d or 0, t or "", t is None, len(gone)))
    return sorted(out)


def rows():
    out = [(i, f"start {i}\nown {i}\n{PASSAGE}\nend {i}\n{LONG}\ntail {i}") for i in range(20, 0, -1)]
    out += [(100, PASSAGE + "\n" + PASSAGE), (101, None), (102, ""), (103, "\n\n\n"), (104, "\n\n\n"), (105, "x\n" * 300), (1, out[-1][1]), (None, PASSAGE), (None, "only"), (106, LONG), (2**63 - 1, f"last\n{PASSAGE}")]
    return out


def test_against_brute_force(spark):
    r = rows()
    assert run(spark, r) == brute(r)


def test_against_brute_force_on_shuffled_lines(spark):
    draw = random.Random(7)
    pool = [" ".join(f"w{draw.randrange(40)}" for _ in range(draw.choice((0, 1, 4, 9, 20, 60)))) for _ in range(25)]
    r = [(i, "\n".join(draw.choice(pool) for _ in range(draw.randint(1, 14)))) for i in range(60)]
    assert run(spark, r) == brute(r)


def test_equal_digests_of_other_bytes_stay(spark, monkeypatch):
    """Every range has one digest: only those with the bytes of the first go."""
    monkeypatch.setattr(L, "_digest", lambda data: b"\0" * 16)
    other = LONG.replace("w5", "v5")
    got = run(spark, [(1, LONG), (2, other), (3, LONG), (4, other + "\nx")])
    assert [(d, t, n) for _, d, t, _, n in got] == [(1, LONG, 0), (2, other, 0), (3, "", 1), (4, other + "\nx", 0)]


def test_digests_that_agree_in_half_are_told_apart(spark, monkeypatch):
    whole = L._digest
    monkeypatch.setattr(L, "_digest", lambda data: b"\1" * 8 + whole(data)[8:])
    monkeypatch.setattr(L, "PER_FILE", 2)
    r = rows()
    assert run(spark, r) == brute(r)


def test_passages_go_and_first_stays(spark):
    got = {d: t for n, d, t, _, _ in run(spark, [x for x in rows() if x[0] and 1 < x[0] < 100])}
    assert PASSAGE.split("\n")[5] in got[2] and LONG in got[2]
    assert all(got[i] == f"start {i}\nown {i}\nend {i}\ntail {i}" for i in range(3, 21))


def test_chunks_cover_the_lines_and_boundaries_move_along():
    for _, t in rows():
        lines = (t or "").encode().split(b"\n")
        parts = L.chunks(lines)
        assert parts[0][0] == 0 and parts[-1][1] == len(lines) and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    a, b = ({b"\n".join(x[i:j]) for i, j in L.chunks(x) if j - i > 1} for x in ((y + PASSAGE + "\nz").encode().split(b"\n") for y in ("", "p\nq\nr\n")))
    assert len(a & b) >= 2


def test_one_very_long_text_and_helper_names_in_use(spark):
    docs = spark.createDataFrame([(1, "x\n" * 100_000 + LONG, 1, 2, 3), (2, LONG, 1, 2, 3)], "doc_id long, text string, _nul int, __DOC int, _ranges int")
    out = L.drop_passages(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[2].text == "" and got[2]._nul == 1 and got[1].text.endswith(LONG) and len(got[1].text) < 1000


def test_empty(spark):
    assert run(spark, []) == []
