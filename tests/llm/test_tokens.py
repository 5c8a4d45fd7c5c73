import random
from array import array

import public_tokenizers
from tokenizers import Tokenizer

from tallygrid.llm import tokens as K

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = K.PrefixCounts(PATH)
PARTS = ["a", "the", " ", "  ", "\n", "'s", "'re", "'ll", "'l", "é", "!", "1", "²", "ing", "ñ", "<|", "|>", "<|endoftext|>", "日", "\t", " ", "\x1c", "_", "🎉"]


def texts():
    draw = random.Random(3)
    fixed = ["", " ", "\n", "hi!<|endoftext|> yes", "<|endoftext|>" * 2, "a   b\n\n c", "'re we'll 'r", "THE!! AND!!"]
    return fixed + ["".join(draw.choice(PARTS) for _ in range(draw.randint(1, 14))) for _ in range(300)]


def count(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_every_prefix_has_the_count_of_the_library():
    counter = K.PrefixCounts(PATH, cache=50)
    for t in texts():
        assert list(counter.prefixes(t)) == [count(t[:i]) for i in range(len(t) + 1)], t


def test_ids_are_those_of_the_library():
    encoder = K.PieceEncoder(PATH, cache=20)
    for t in texts():
        assert list(array("I", encoder.encode([t])[0])) == LIBRARY.encode(t, add_special_tokens=False).ids, t


def test_fast_cut_agrees_on_all_characters_that_use_it():
    pieces = K._Pieces(PATH)
    for c in map(chr, range(0x3000)):
        if not K._KNOWN.search(c):
            t = f"a{c} b1{c}{c}2 {c}'s _{c}"
            assert K._FIND(t) == [t[a:b] for _, (a, b) in pieces.library.pre_tokenizer.pre_tokenize_str(t)]


def test_truncation():
    counter = K.PrefixCounts(PATH)
    t = "Some words, and then some more of them. " * 5
    for budget in (0, 1, 7, 30, 10_000):
        n = counter.truncate(t, budget)
        assert all(count(t[:i]) <= budget for i in range(n + 1)) and (n == len(t) or count(t[: n + 1]) > budget)


def test_query(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, None), (5, "word " * 3000), (6, "x" * 3000)]
    got = K.count_tokens(spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, n_bytes int"), PATH, 12).collect()
    for r, (d, t) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_bytes)), sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, len((x[1] or "").encode())))):
        assert (r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) == (d, len((t or "").encode()), count(t or ""), count(t or "") > 12)
        assert r.keep_chars == COUNTER.truncate(t or "", 12)
    assert K.count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_lengths(spark):
    rows = [(1, "hello there"), (2, None), (3, "<|endoftext|>")]
    got = K.token_lengths(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 1)
    n = {r.doc_id: r.length for r in got.collect()}
    assert n[1] == count("hello there") + 1 and n[2] == 1 and n[3] > 2


def test_counts_that_fall_below_256_again():
    draw = random.Random(434)
    piece = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(470))[:441]
    counts = list(K.PrefixCounts(PATH).piece(piece))
    assert counts[-2:] == [256, 255] == [count(piece[:-1]), count(piece)]
    assert K.PrefixCounts(PATH).truncate(piece, 254) == next(i - 1 for i, c in enumerate([0, *counts]) if c > 254)
