"""Exact token counts and ids of a byte-level BPE vocabulary.

The vocabulary cuts a text into pieces by a fixed pattern and encodes each piece by itself.
`PieceEncoder` keeps the ids that the library gives for each different piece. `PrefixCounts`
finds the token count at every prefix of a piece by dynamic programming: each prefix has one
last token, namely the one whose pair with the last token of the shorter prefix is stable
under the merges, so its count is that of the shorter prefix plus one.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Characters on which the library's pattern and this one are tested to agree; other texts are cut by the library.
_KNOWN = re.compile(r"[^\t\n\r\x20-\x7e¡-±´-¸º»¿-ʯΑ-ΡΣ-ωА-я‐-‧€]")
#: The library's pattern for those characters, in the terms of `re`, which is the faster engine.
_FIND = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
#: Entries of a generation of a piece cache. When one is full it becomes the older one, from which
#: pieces that are met again move to the new one; the older one before it is dropped.
CACHE = 400_000
#: Longer pieces are not kept.
LONGEST_KEPT = 64


_SHORT = (2, 1)


class _Pieces:
    """Cuts texts as the vocabulary file says."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self._special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")

    def segments(self, text: str) -> list[tuple[str, bool]]:
        """Stretches of text, and whether each is a special token."""
        if not any(s in text for s in self.specials):
            return [(text, False)]
        out, at = [], 0
        for m in self._special.finditer(text):
            out += [(text[at : m.start()], False), (m[0], True)]
            at = m.end()
        return [x for x in [*out, (text[at:], False)] if x[0]]

    def cut(self, text: str) -> list[str]:
        """The pieces of a stretch without special tokens."""
        if not _KNOWN.search(text):
            return _FIND(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]


def byte_letters() -> list[str]:
    """The letter that stands for each byte value in a byte-level vocabulary: printable ones for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class PieceEncoder(_Pieces, dict):
    """Token ids of whole texts. Each different piece is encoded once by the library and kept in this dict."""

    def __init__(self, path: str, cache: int = CACHE):
        super().__init__(path)
        self._letters = dict(enumerate(byte_letters()))
        self._tokenize = self.library.model.tokenize
        self._most, self._older = cache, {}

    def __missing__(self, piece: str) -> bytes:
        if (ids := self._older.get(piece)) is not None:
            self[piece] = ids
            return ids
        if piece.isascii() and piece.isprintable():
            letters = piece.replace(" ", self._letters[32])
        else:
            letters = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._letters)
        ids = array("I", [t.id for t in self._tokenize(letters)]).tobytes()
        if len(piece) <= LONGEST_KEPT:
            self[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self) > self._most:
            self._older = dict(self)
            self.clear()
        get, cut = self.__getitem__, self.cut
        return [
            b"".join(
                array("I", [self.specials[s]]).tobytes() if special else b"".join(map(get, cut(s)))
                for s, special in self.segments(t)
            )
            for t in texts
        ]


class PrefixCounts(_Pieces):
    """Token counts at every prefix."""

    def __init__(self, path: str, cache: int = CACHE):
        super().__init__(path)
        import json

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        shown = {c: b for b, c in enumerate(byte_letters())}
        self._rank = {bytes(shown[c] for c in t): i for t, i in model["vocab"].items() if all(c in shown for c in t)}
        # Lengths of the tokens that end in three given bytes, longest first.
        lengths: dict[bytes, set[int]] = {}
        for token in self._rank:
            if len(token) >= 3:
                lengths.setdefault(token[-3:], set()).add(len(token))
        self._lengths = {end: (*sorted(n, reverse=True), 2, 1) for end, n in lengths.items()}
        ids, self._joined = model["vocab"], {}
        # A token of one byte is made of itself.
        self._left = {i: i for i in self._rank.values()}
        self._right = dict(self._left)
        for merge in model["merges"]:
            x, y = (ids[t] for t in (merge.split(" ") if isinstance(merge, str) else merge))
            both = ids["".join(merge.split(" ") if isinstance(merge, str) else merge)]
            self._joined[x, y] = both
            self._left[both], self._right[both] = x, y
        self._stable: dict[int, bool] = {}
        self._kept: dict[str, array | bytes] = {}
        self._older: dict[str, array | bytes] = {}
        self._most = cache

    def _pair(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b ends in these two tokens.

        It does unless, while both were being made, tokens stood at the seam whose merge comes
        before the one that made the later of the two. The makings are undone, the latest first.
        """
        key = a << 20 | b
        joined, x, y, before = self._joined, a, b, 1 << 60
        while True:
            if joined.get((x, y), before) < before:
                found = False
                break
            inner_x, inner_y = self._right[x], self._left[y]
            if inner_x == x and inner_y == y:
                found = True
                break
            # A merge at the seam of equal rank comes first only if it begins further left.
            if inner_y == y or (inner_x != x and x > y):
                before, x = x, inner_x
            else:
                before, y = y + 1, inner_y
        if len(self._stable) >= self._most:
            self._stable.clear()
        self._stable[key] = found
        return found

    def piece(self, piece: str) -> array | bytes:
        """Counts at the prefixes of 1, 2, ... code points of one piece."""
        if (found := self._kept.get(piece)) is not None:
            return found
        if (found := self._older.get(piece)) is not None:
            return self._keep(piece, found)
        data = piece.encode("utf-8", "surrogatepass")
        rank, n, lengths = self._rank.get, len(data), self._lengths.get
        last, count, stable = [0] * (n + 1), [0] * (n + 1), self._stable.get
        for i in range(1, n + 1):
            for size in lengths(data[i - 3 : i], _SHORT) if i > 2 else _SHORT:
                start = i - size
                if start >= 0 and (token := rank(data[start:i])) is not None:
                    if start:
                        if (fits := stable(last[start] << 20 | token)) is None:
                            fits = self._pair(last[start], token)
                        if not fits:
                            continue
                    last[i], count[i] = token, count[start] + 1
                    break
        if n == len(piece):
            counts = count[1:]
        else:
            counts = [count[i] for i in range(1, n + 1) if i == n or data[i] & 0xC0 != 0x80]
        # Counts can fall: an inner prefix can have more tokens than the whole.
        out = bytes(counts) if max(counts) < 256 else array("I", counts)
        return self._keep(piece, out) if len(piece) <= LONGEST_KEPT else out

    def _keep(self, piece: str, counts: array | bytes) -> array | bytes:
        if len(self._kept) >= self._most:
            self._older = dict(self._kept)
            self._kept.clear()  # in place: totals() holds its lookup
        self._kept[piece] = counts
        return counts

    def totals(self, text: str) -> tuple[list[str], list[int]]:
        """Pieces (special tokens as they are) and the count of each."""
        pieces: list[str] = []
        counts: list[int] = []
        kept, piece = self._kept.get, self.piece
        for s, special in self.segments(text):
            if special:
                pieces.append(s)
                counts.append(1)
            else:
                found = self.cut(s)
                pieces += found
                counts += [(kept(p) or piece(p))[-1] for p in found]
        return pieces, counts

    def prefixes(self, text: str) -> array:
        """Token count of text[:i] for i = 0 ... len(text), each as the library would give it.

        A prefix can be cut otherwise than the text: in a run of white space, inside a
        contraction, and inside a special token. These are counted by their own cut.
        """
        out = array("I", [0])
        base, before = 0, ""
        for s, special in self.segments(text):
            if special:
                # A part of the special string is ordinary text, and may join the piece before it.
                whole = base - sum(self.piece(p)[-1] for p in self.cut(before))
                for i in range(1, len(s)):
                    out.append(whole + sum(self.piece(p)[-1] for p in self.cut(before + s[:i])))
                base += 1
                out.append(base)
                before = ""
                continue
            before, base = s, self._stretch(s, base, out)
        return out

    def _stretch(self, s: str, base: int, out: array) -> int:
        """Append the counts of the prefixes of a stretch; return the count at its end."""
        pieces = self.cut(s)
        i, skip = 0, 0
        while i < len(pieces):
            p = pieces[i]
            if p.isspace():
                # A prefix that ends in a run of white space takes the whole run as one piece.
                end = i
                while end < len(pieces) and pieces[end].isspace():
                    end += 1
                run = "".join(pieces[i:end])
                skip = int(end < len(pieces) and pieces[end][0].isspace())
                out.extend(base + c for c in self.piece(run + " " * skip))
                base += sum(self.piece(p)[-1] for p in pieces[i:end])
                i = end
                continue
            counts = self.piece(p)
            if p in ("'re", "'ve", "'ll"):
                lone = self.piece("'")[-1]
                counts = [lone, lone + self.piece(p[1])[-1], counts[-1]]
            out.extend(base + c for c in counts[skip:])
            base += counts[-1]
            i, skip = i + 1, 0
        return base

    def truncate(self, text: str, budget: int) -> int:
        """The most code points of `text` whose prefix, and every shorter one, has `budget` tokens or fewer."""
        counts = self.prefixes(text)
        return next((i - 1 for i, c in enumerate(counts) if c > budget), len(text))


_made: dict[tuple[type, str], _Pieces] = {}


def maker(kind: type, path: str):
    """One instance per worker process."""
    if (kind, path) not in _made:
        _made[kind, path] = kind(path)
    return _made[kind, path]


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, keep_chars for every whole text.

    n_tokens is the count at the full length; over_limit says whether it is above `limit`;
    keep_chars is the number of code points up to which every prefix stays within `limit`.
    All come from the prefix counts; nothing is encoded again. A null text is empty: zero
    bytes and tokens. Repeated rows and null doc_ids are answered row by row; other columns
    are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        counter = maker(PrefixCounts, path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            totals, keep = [], []
            for t in texts:
                pieces, counts = counter.totals(t)
                n = sum(counts)
                totals.append(n)
                if n <= limit and not any(len(p) > limit for p in pieces):
                    keep.append(len(t))
                    continue
                # Pieces beyond the one that crosses the limit do not matter.
                ends = accumulate(counts)
                at = next((i for i, e in enumerate(ends) if e > limit), len(pieces) - 1)
                keep.append(counter.truncate(t[: sum(map(len, pieces[: at + 2]))], limit))
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([n > limit for n in totals], pa.bool_()),
                    pa.array(keep, pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "keep_chars"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, keep_chars long"
    )


def token_lengths(docs: DataFrame, ranks_path: str, pattern: str, extra: int = 0, specials: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and length: tokens of every whole text, plus `extra`. A null text is empty.

    The vocabulary is a file of base64 tokens and ranks. Each of `specials` in a text is one
    token, as `PieceEncoder` has it, and nothing joins across it. Only the numbers of tokens are kept.
    Rows are answered one by one; other columns are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        vocabulary = _ranks(ranks_path, pattern, specials)
        plain, marked = vocabulary.encode_ordinary, vocabulary.encode
        for batch in batches:
            n = []
            for t in batch.column(1).to_pylist():
                t = t or ""
                n.append(extra + len(marked(t, allowed_special="all") if any(s in t for s in specials) else plain(t)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["doc_id", "length"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, length long")


@lru_cache(maxsize=1)
def _ranks(path: str, pattern: str, specials: tuple[str, ...] = ()):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    marks = {s: max(ranks.values()) + 1 + i for i, s in enumerate(specials)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=marks)
