import random
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stridebase.llm import packing
from stridebase.llm.queries import TOKENIZER


def best_fit_decreasing(lengths, capacity):
    """Number of bins, one piece at a time."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


def rooms_of(plan, counts, capacity):
    """Remaining rooms of the plan's bins; checks that pieces do not overlap."""
    used = defaultdict(list)
    rows = sorted(plan)
    for i, (length, rank, first, offset, each) in enumerate(rows):
        end = rows[i + 1][1] if i + 1 < len(rows) and rows[i + 1][0] == length else counts[length]
        for r in range(rank, end):
            used[first + (r - rank) // each].append((offset + (r - rank) % each * length, length))
    out = []
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        out.append(capacity - at)
    assert sum(map(len, used.values())) == sum(counts.values())
    return sorted(out)


@given(st.dictionaries(st.integers(1, 24), st.integers(1, 9)), st.just(24))
@settings(max_examples=200, deadline=None)
def test_plan_is_best_fit_decreasing(counts, capacity):
    lengths = [n for n, c in counts.items() for _ in range(c)]
    assert rooms_of(packing.plan_bins(counts, capacity), counts, capacity) == best_fit_decreasing(lengths, capacity)


def test_plan_of_many_pieces_is_small():
    rng = random.Random(1)
    counts = {n: rng.randrange(1, 10**9) for n in range(1, 1025)}
    assert len(packing.plan_bins(counts, 1024)) < 50_000


def test_plan_refuses_what_does_not_fit():
    assert packing.plan_bins({}, 8) == []
    for wrong in (0, 9):
        with pytest.raises(ValueError):
            packing.plan_bins({wrong: 1}, 8)


def test_tightest_room():
    rooms = packing.Rooms(10)
    for r in (3, 7, 10):
        rooms.set(r, True)
    assert [rooms.tightest(n) for n in range(11)] == [3, 3, 3, 3, 7, 7, 7, 7, 10, 10, 10]
    rooms.set(10, False)
    assert rooms.tightest(8) is None and rooms.tightest(10) is None


@lru_cache
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def ids_of(text):
    return np.array(tokenizer().encode(text or "", add_special_tokens=False).ids + [2], "<u4")


BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2003\u2028\u3000"


@lru_cache
def encoder():
    return packing.Encoder(TOKENIZER)


@given(st.text(st.one_of(st.sampled_from(BLANKS + "ab'sé1!,漢²"), st.characters(codec="utf-8")), max_size=30))
@settings(max_examples=500, deadline=None)
def test_ids_are_those_of_the_library(text):
    assert encoder()(text) == ids_of(text)[:-1].tobytes()


@given(st.text(st.characters(max_codepoint=0x24F), max_size=40))
@settings(max_examples=1000, deadline=None)
def test_fast_ids_are_those_of_the_library(text):
    assert encoder().fast is not None
    assert encoder()(text) == ids_of(text)[:-1].tobytes()


@pytest.mark.parametrize("text", ["", "<|endoftext|> x<|endoftext|>", "a" * 50_000, " " * 5000, "it's we'll 12 ½ ²³ ª º ß ŉ ǰ"])
def test_special_texts(text):
    assert encoder()(text) == ids_of(text)[:-1].tobytes()


@pytest.mark.parametrize("blank", [" ", "\n", " \n\t"])
def test_very_long_runs_of_blanks(blank):
    edge = packing.LONGEST_BLANK
    for text in (f"a{blank * 1_000_100}b", blank * 1_000_100, "x" + " " * edge + "y" + "\n" * (edge + 1)):
        assert encoder()(text) == ids_of(text)[:-1].tobytes()


def test_other_kinds_of_files_take_the_library():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encode = packing.Encoder(path)
    assert encode.fast is None
    assert encode("Hello there") == np.array(Tokenizer.from_file(path).encode("Hello there", add_special_tokens=False).ids, "<u4").tobytes()


DOCS = [(1, "a b"), (2, None), (3, ""), (3, ""), (None, "hello"), (4, "word " * 5000), (5, "  x"), (6, "x " * 1023), (7, "y " * 1022)]


def test_pieces_and_sequences(spark):
    docs = spark.createDataFrame([(*d, 1, "p") for d in DOCS], "doc_id long, text string, piece int, sequence_id string")
    pieces = packing.token_pieces(docs, TOKENIZER)
    packed = packing.pack(pieces).collect()
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in packed:
        of_doc[r["doc_id"]].append(r)
        of_sequence[r["sequence_id"]].append(r)
    for doc, text in DOCS:
        rows = sorted(of_doc[doc], key=lambda r: r["piece"])
        if doc == 3:
            assert [bytes(r["ids"]) for r in rows] == [ids_of("").tobytes()] * 2
            continue
        ids = ids_of(text)
        assert b"".join(bytes(r["ids"]) for r in rows) == ids.tobytes()
        assert [r["piece"] for r in rows] == list(range(len(rows)))
        assert [r["start"] for r in rows] == list(np.cumsum([0, *(r["length"] for r in rows)])[:-1])
        assert all(r["length"] == 1024 for r in rows[1:]) and len(rows) == -(-len(ids) // 1024)
    for rows in of_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert len(of_sequence) == len(best_fit_decreasing([r["length"] for r in packed], 1024))

    whole = packing.sequences(packing.pack(pieces)).collect()
    assert sorted(r["length"] for r in whole) == sorted(sum(r["length"] for r in rows) for rows in of_sequence.values())
    assert all(len(r["ids"]) == 4 * r["length"] for r in whole)
    assert sum(r["pieces"] for r in whole) == len(packed)


def test_pack_keeps_columns_and_takes_no_rows(spark):
    rows = spark.createDataFrame([(5, "a", 1, 2), (3, "b", 3, 4), (5, "a", 1, 2)], "length int, _part string, _row int, offset int")
    got = packing.pack(rows, 8)
    assert got.columns == ["length", "_part", "_row", "sequence_id", "offset"]
    assert sorted((r["length"], r["offset"]) for r in got.collect()) == [(3, 5), (5, 0), (5, 0)]
    assert packing.pack(rows.where("false"), 8).collect() == []
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.token_pieces(empty, TOKENIZER)).collect() == []


def test_wrong_lengths_are_errors(spark):
    for wrong in (None, 0, 9):
        with pytest.raises(ValueError):
            packing.pack(spark.createDataFrame([(wrong,)], "length int"), 8)
