import hashlib
import random
from collections import Counter

import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tallygrid.llm import alignment, queries
from tallygrid.llm.tokens import byte_letters

PATHS = alignment.Vocabularies(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))
A = Tokenizer.from_file(PATHS.a)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS.b)
SHOWN = {c: b for b, c in enumerate(byte_letters())}


def tokens(text):
    """Ids and bytes of both for a whole text, by the libraries; nothing if a side does not give the text back."""
    if not text:
        return [], []
    a = [(i, bytes(SHOWN[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()) for i in B.encode(text)]
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in (a, b)):
        return [], []
    return a, b


def ends(side):
    at, out = 0, []
    for i, data in side:
        at += len(data)
        out.append((at, i))
    return out


def expected(texts):
    """Rows of all texts, each aligned as a whole."""
    sides = [tuple(map(ends, tokens(t))) for t in texts]
    links = [[(x, y) for e, x in a for f, y in b if e == f] if len(a) < 400 else [(x, dict(b)[e]) for e, x in a if e in dict(b)] for a, b in sides]
    count = Counter(p for found in links for p in found)
    most = {}
    for (_, y), c in count.items():
        most[y] = max(most.get(y, 0), c)
    out = []
    for (a, b), found in zip(sides, links):
        cuts = sorted({e for e, _ in a} & {e for e, _ in b})
        said, low = [], 0
        for cut in cuts:
            said.append("|".join(",".join(str(i) for e, i in side if low < e <= cut) for side in (a, b)))
            low = cut
        digest = hashlib.sha256(";".join(said).encode()).hexdigest() if a else ""
        out.append((len(a), len(b), len(cuts), len(found), sum(count[p] == most[p[1]] for p in found), sum(count[p] for p in found), digest))
    return out


PARTS = ["a", "the", "Thntre", "  ", " ", " ", " ", "\n", "\t", "'s", "'re", "é", "ﬁ", "①", "日本", "🎉", ".", "!?", "12", "<s>", "<|endoftext|>", "<0x0A>", " ", "　", "\x1c", "\x00", "​", "_"]


def texts():
    draw = random.Random(11)
    fixed = [None, "", " ", "  ", "\n", "a ", " a", "a  b", "a \n b", "\n\nx", "▁", "a ▁ b", "word " * 60, "x" * 500, "no spaces" * 30, "Hello there", "Hello there"]
    return fixed + ["".join(draw.choice(PARTS) for _ in range(draw.randint(1, 25))) for _ in range(250)]


@pytest.fixture(params=["plain", "many files"])
def sizes(request, monkeypatch):
    if request.param == "many files":
        for name, value in (("COUNTED", 20), ("PER_FILE", 30), ("KEPT", 10)):
            monkeypatch.setattr(alignment, name, value)


def test_rows_are_those_of_whole_texts(spark, sizes):
    rows = [(i, t, 7) for i, t in enumerate(texts())] + [(None, "Hello there", 7), (3, "again", 7)]
    got = alignment.align_corpus(spark.createDataFrame(rows, "doc_id long, text string, n_a int"), PATHS).collect()
    want = sorted((i is None, i or 0, *x) for (i, _, _), x in zip(rows, expected([t for _, t, _ in rows])))
    assert sorted((r.doc_id is None, r.doc_id or 0, *tuple(r)[1:]) for r in got) == want


def test_stretches_are_encoded_as_in_the_text():
    encoders = alignment.Encoders(PATHS)
    for t in texts():
        if alignment.usable(t):
            parts = alignment.stretches(t)
            assert " ".join(parts) == t
            a, b = encoders.encode(parts)
            assert [i for x in a for i in x] == A.encode(" " + t, add_special_tokens=False).ids and [i for x in b for i in x] == B.encode(t), t


def test_both_engines_of_the_first_vocabulary_agree():
    encoders = alignment.Encoders(PATHS)
    chars = [c for c in map(chr, range(0x3000)) if not alignment.KNOWN.search(c)]
    draw = random.Random(4)
    said = [f"a{c} b1{c}{c}2 {c}'s _{c}{c}" for c in chars] + ["".join(draw.choices(chars, k=60)) for _ in range(500)]
    for t in said:
        assert encoders._encode_a(t) == A.encode(t, add_special_tokens=False).ids, t


def test_another_seed_where_two_stretches_have_one_key(spark, monkeypatch):
    key = alignment._key
    monkeypatch.setattr(alignment, "_key", lambda p, seed: 5 if seed == 0 and p in ("one", "two") else key(p, seed))
    docs = spark.createDataFrame([(1, "one two three"), (2, "two")], "doc_id long, text string")
    got = alignment.align_corpus(docs, PATHS).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == expected(["one two three", "two"])


def test_fast_cut_is_the_cut():
    for t in filter(None, texts()):
        assert alignment.stretches(t) == alignment._CUT.split(t)


def test_every_character_but_one_comes_back():
    encoders = alignment.Encoders(PATHS)
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i) != alignment.LOST]
    for i in range(0, len(chars), 300):
        encoders.encode(["".join(chars[i : i + 300]), "a".join(chars[i : i + 300])])  # raises if not


def test_groups_of_texts(spark):
    docs = spark.createDataFrame([(5, "Thntre wordéd 12"), (None, "a"), (6, None)], "doc_id long, text string")
    rows = alignment.align_texts(docs, PATHS).orderBy("doc_id", "grp").collect()
    said = ";".join(f"{','.join(map(str, r.a))}|{','.join(map(str, r.b))}" for r in rows if r.doc_id == 5)
    assert hashlib.sha256(said.encode()).hexdigest() == expected(["Thntre wordéd 12"])[0][-1]
    assert {r.doc_id for r in rows} == {5, None}


def test_empty(spark):
    assert alignment.align_corpus(spark.createDataFrame([], "doc_id long, text string"), PATHS).collect() == []


def test_query_is_whole(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").toPandas()
    got = queries.QUERIES["op11_cross_tokenizer_alignment"](spark, data).toPandas().set_index("doc_id").loc[docs.doc_id]
    want = expected(list(docs.text))
    assert [tuple(r) for r in got.itertuples(index=False)] == want
