"""Alignment of two tokenizers against a brute-force form over documents, groups and links."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stridebase.llm import alignment, queries
from stridebase.llm.tables import table
from tests.conftest import SF_DIR

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute_force(rows):
    """The rows of the result by definition, documents as (id, text)."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}

    def bytes_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    laid = []
    for _, text in rows:
        groups = []
        if text:
            a = first.encode(" " + text, add_special_tokens=False).ids
            b = second.encode(text)
            ta = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
            tb = [bytes_b(i) for i in b]
            if b"".join(ta) == b"".join(tb) == (" " + text).encode():
                i = j = x = y = 0
                now = ([], [])
                while i < len(a) or j < len(b):
                    if x <= y and i < len(a):
                        now[0].append(a[i])
                        x += len(ta[i])
                        i += 1
                    else:
                        now[1].append(b[j])
                        y += len(tb[j])
                        j += 1
                    if x == y:
                        groups.append(now)
                        now = ([], [])
        laid.append(groups)
    counts = Counter()
    for groups in laid:
        counts.update({(a, b) for x, y in groups for a in x for b in y})
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for (doc, _), groups in zip(rows, laid):
        links = [(a, b) for x, y in groups for a in x for b in y]
        printed = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append(
            (
                doc, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                hashlib.sha256(printed.encode()).hexdigest() if printed else "",
            )
        )
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def check(df, got):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_force(rows), key=key)


ODD = [
    None, "", " ", "a", "plain words, twice: plain words", "plain words, twice: plain words", "<|endoftext|> and <s> </s> <unk>",
    "a▁b", "tab\tand\nline\r\n  ends  ", "\U0001f600\U0001f601 emoji", "你好世界", "café café", "nul\x00in", "x" * 500, " " * 300,
    "  spaces", "퟿￿", "Straße", "0x41 <0x41> 12345",
]


def test_odd_texts(spark):
    df = spark.createDataFrame(list(enumerate(ODD)) + [(None, "plain words"), (3, "again")], "doc_id long, text string")
    check(df, alignment.align(df.repartition(3), A, B))


def test_many_blocks_and_steps(spark, monkeypatch):
    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(alignment, "SMALL_GROUP", 3)
    known = alignment.vocabularies(A, B)
    texts = [t for t in ODD if t] * 2
    a, b = zip(*known.encode(texts))
    laid = alignment.Overlay(known, list(a), list(b))
    got = [(d, p, n) for part in laid.pairs() for d, p, n in zip(*part[2:])]
    monkeypatch.undo()
    whole = [(d, p, n) for part in alignment.Overlay(known, list(a), list(b)).pairs() for d, p, n in zip(*part[2:])]
    assert got == whole and sum(n for _, _, n in got) == laid.links.sum()


def test_blocks_do_not_change_the_counts(spark):
    rows = [(i, f"words number {i % 7} und straße thheouble") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check(df, alignment.align(df, A, B))


@pytest.mark.parametrize("text", [" " * 1_200_000, "ab" * 500_000, "\U0001f600" * 100_000])
def test_very_long_texts(spark, text):
    row = alignment.align(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B).first()
    assert row["n_groups"] > 0 and row["n_best"] <= row["n_links"] <= row["count_sum"] == row["n_links"]


def test_empty_table_and_clashing_columns(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
    df = spark.createDataFrame([("k", "some words", 1, 2, 3)], "doc_id string, text string, block int, pair int, a int")
    check(df, alignment.align(df, A, B))


def test_whole_table(spark):
    check(table(spark, SF_DIR, "documents"), queries.op11_alignment(spark, SF_DIR))
