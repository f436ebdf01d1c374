"""Operator 11 against both libraries and a plain search for overlaps."""

import hashlib
from collections import Counter

import pytest

from glossmill.llm import alignment
from glossmill.llm.piececoding import MARK

TEXTS = [
    "The quick brown fox, the quick brown dog.", "the the the", None, "", " ", "  ", "   x", "a  b   c ", "tab\tand\n\nlines \n x", "naïve café déjà vu à la à b",
    "汉字 漢字かな ｶﾅ 🙂🙃 é", "no break   　 x  y", f"a{MARK}b c", "<|endoftext|> plain </s> <s> text", "x" * 3000 + " " + "ab " * 500, "\x1c \x1f x\x85 y", "'s don't we'll I'M",
    "1234 56,789.00 $%&", "the the the", "  a  b  c  d  e",
]


def plain(rows):
    """What the contract says, one document at a time, by comparing every token with every token."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    a_side = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    letters = sorted(ByteLevel.alphabet())
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    byte_of = {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in visible)}
    assert sorted(byte_of) == letters

    def b_bytes(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace(MARK, " ").encode()

    docs, counts = [], Counter()
    for key, text in rows:
        whole = (" " + (text or "")).encode()
        a = [(i, bytes(byte_of[c] for c in a_side.id_to_token(i))) for i in a_side.encode(whole.decode(), add_special_tokens=False).ids] if text else []
        b = [(i, b_bytes(i)) for i in b_side.encode(text)] if text else []
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a = b = []
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links = [(x[0], y[0]) for x in spans[0] for y in spans[1] if x[1] < y[2] and y[1] < x[2]] if len(whole) < 2000 else None
        if links is None:  # sorted sweep for long texts
            links, j = [], 0
            for x in spans[0]:
                while spans[1][j][2] <= x[1]:
                    j += 1
                k = j
                while k < len(spans[1]) and spans[1][k][1] < x[2]:
                    links.append((x[0], spans[1][k][0]))
                    k += 1
        counts.update(links)
        ends = sorted({x[2] for x in spans[0]} & {x[2] for x in spans[1]})
        groups, low = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(x[0]) for x in side if low < x[2] <= end) for side in spans))
            low = end
        docs.append((key, len(a), len(b), links, groups))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return sorted(
        (key, na, nb, len(g), len(ln), sum(counts[x] == best[x[1]] for x in ln), sum(counts[x] for x in ln), hashlib.sha256(";".join(g).encode()).hexdigest() if na else "", ";".join(g))
        for key, na, nb, ln, g in docs
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]


@pytest.mark.parametrize("slice_bytes", [1, 200, 4 << 20])
def test_alignment_equals_a_plain_search(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(alignment, "SLICE", slice_bytes)
    rows = [(n, t) for n, t in enumerate(TEXTS)] + [(3, "the the the")]
    given = spark.createDataFrame([(n, t, 1, "x") for n, t in rows], "doc_id long, text string, slice int, groups string").repartition(3)
    got = sorted(tuple(r) for r in alignment.align(given, keep_groups=True).select(*COLUMNS).collect())
    assert got == plain(rows)


def test_alignment_of_the_test_data(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in alignment.query(spark, data).select(*COLUMNS[:-1]).collect())
    assert got == [x[:-1] for x in plain(rows)]


def test_alignment_of_nothing_and_of_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, "a b")], "doc_id long, text string")
    assert sorted((r["n_a"], r["groups_sha256"] == "") for r in alignment.align(nulls).collect()) == [(0, True), (2, False)]
