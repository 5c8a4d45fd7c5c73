from pyspark.sql import functions as F

import corpus_pipeline
from tallygrid.llm import decontam, linededup, quality, simhash
from tallygrid.llm.common import table

from test_neardup import brute as near_brute
from test_linededup import ranges


def test_stages_in_turn(spark, data, tmp_path):
    docs = table(spark, data, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "best-fit packing"]
    frames = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frames[-1], data)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{i}")
        frames.append(spark.read.parquet(f"{tmp_path}/{i}"))
    ids = lambda f: {r.doc_id for r in f.select("doc_id").collect()}
    good = {r.doc_id for r in quality.score_quality(docs, table(spark, data, "labels")).collect() if r.predicted}
    assert ids(frames[1]) == good and ids(frames[2]) == good
    # Line dedup by the bytes themselves.
    before, first = sorted((r.doc_id, r.text) for r in frames[1].collect()), {}
    cut = {d: ranges(t) for d, t in before}
    for d, (lines, found) in cut.items():
        for a, b in sorted(found):
            first.setdefault("\n".join(lines[a:b]), (d, b))
    want = {}
    for d, (lines, found) in cut.items():
        gone = set()
        for a, b in found:
            e, stop = first["\n".join(lines[a:b])]
            if e < d or stop <= a:
                gone.update(range(a, b))
        want[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    assert {r.doc_id: r.text for r in frames[2].collect()} == want
    # Near copies by all pairs of five-word shingles.
    stay, _ = near_brute([(d, t, d) for d, t in sorted(want.items())])
    assert ids(frames[3]) == stay
    leaks = ids(decontam.contaminated(frames[3], table(spark, data, "benchmark")))
    assert ids(frames[4]) == ids(frames[3]) - leaks
    packed = {i.doc_id for r in frames[5].collect() for i in r["items"]}
    assert packed == ids(frames[4])
    whole = corpus_pipeline.run(spark, data)
    assert sorted(map(str, whole.collect())) == sorted(map(str, frames[5].collect()))


def test_extra_columns(spark, data):
    extra = ("row", "component_id", "__doc1", "__doc", "__h", "__place", "_doc", "_nul", "mark", "node", "hits", "label", "x", "fold", "start", "_Ranges")
    docs = table(spark, data, "documents").limit(60).selectExpr("*", *(f"{i} as {c}" for i, c in enumerate(extra)))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns
        assert all(r[c] == i for r in out.collect() for i, c in enumerate(extra))
    assert len(corpus_pipeline.STAGES[4][1](spark, docs, data).collect()) > 0
    for f in (simhash.keep_one, linededup.dedup_lines):
        assert [c for c in f(docs).columns if c != "n_removed"] == docs.columns and f(docs).count() > 0


def run_on(spark, data, tmp_path, docs):
    for name in ("labels", "benchmark"):
        table(spark, data, name).write.parquet(f"{tmp_path}/{name}.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return corpus_pipeline.run(spark, str(tmp_path)).collect()


def test_empty_documents(spark, data, tmp_path):
    assert run_on(spark, data, tmp_path, table(spark, data, "documents").where("false")) == []


def test_null_ids_repeated_rows_and_a_very_long_text(spark, data, tmp_path):
    docs = table(spark, data, "documents")
    some = docs.limit(80)
    long = docs.where("doc_id = 1").selectExpr("-5L AS doc_id", "repeat(concat(text, '\n'), 400) AS text", *(c for c in docs.columns if c not in ("doc_id", "text"))).select(docs.columns)
    null = some.limit(5).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.concat(F.reverse("text"), F.lit(" own")))
    bins = run_on(spark, data, tmp_path, some.unionByName(some.limit(10)).unionByName(long).unionByName(null).unionByName(null))
    items = [(i.doc_id, i.start) for b in bins for i in b["items"]]
    assert len(items) == len(set((d, s) for d, s in items if d is not None)) + sum(d is None for d, _ in items) > 0
    assert all(b.used == sum(i.length for i in b["items"]) <= b.capacity for b in bins)
