import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallygrid.llm import records as R

PATH = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [(7, "hello there"), (3, None), (5, ""), (None, "no id"), (4, "x <|endoftext|> y é日本"), (7, "again"), (9, "word " * 30_000), (-2, "a\n\n b")]


def test_files_hold_every_document(spark, tmp_path):
    docs = spark.createDataFrame([(d, t, "z") for d, t in ROWS], "doc_id long, text string, start string").repartition(2)
    got = [tuple(r) for r in R.encode_to_records(docs, PATH, f"file://{tmp_path}").collect()]
    lib, want, start = Tokenizer.from_file(PATH), [], 0
    for d, t in sorted(ROWS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    assert sorted(got, key=lambda x: x[1]) == want
    # Shuffled reads through the index.
    uris = sorted(str(p) for p in tmp_path.iterdir() if p.suffix != ".idx" and ".crc" not in p.name)
    spots = [(u, i) for u in uris for i in range(len(R.RecordFile(u)))]
    random.Random(0).shuffle(spots)
    read = [R.RecordFile(u).read(i) for u, i in spots]
    assert sorted((d, zlib.crc32(ids)) for d, ids in read if d is not None) == sorted((d, c) for d, _, _, c in want if d is not None)
    assert not [p for p in tmp_path.iterdir() if len(p.name.split(".")[0]) != len("part-00000000")]


def test_one_doc_id_is_cut_into_many_files(spark, tmp_path):
    rows = [(None if i % 2 else i, f"text {i * 37 % 101} " * (i % 9)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    files = R.write_records(docs, PATH, f"file://{tmp_path}", rows_per_file=10).collect()
    assert len(files) > 12 and sum(f.n_records for f in files) == 200 and max(f.n_records for f in files) < 60
    lib = Tokenizer.from_file(PATH)
    want = [[*lib.encode(t, add_special_tokens=False).ids, 2] for _, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]
    got = []
    for f in sorted(files, key=lambda f: f.part):
        file = R.RecordFile(f.uri)
        got += [np.frombuffer(file.read(i)[1], "<u4").tolist() for i in range(len(file))]
    assert got == want


def test_damage_is_found():
    framed = R.frame(b"payload")
    assert R.unframe(framed) == b"payload"
    for i in range(len(framed)):
        with pytest.raises(ValueError):
            R.unframe(framed[:i] + bytes([framed[i] ^ 1]) + framed[i + 1 :])


def test_empty_table(spark, tmp_path):
    assert R.encode_to_records(spark.createDataFrame([], "doc_id long, text string"), PATH, f"file://{tmp_path}/x").collect() == []
