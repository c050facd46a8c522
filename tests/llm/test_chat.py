import time
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stridebase.llm import chat
from stridebase.llm.tables import table
from tests.conftest import SF_DIR

SF = SF_DIR.replace("sf0.001", "sf0.01")
N = len(chat.STATES)


def random_model(seed):
    rng = np.random.default_rng(seed)
    return chat.Model(rng.integers(-9, 0, N), rng.integers(-9, 0, (N, N)))


def score(model, emissions, states):
    return model.start[states[0]] + sum(e[s] for e, s in zip(emissions, states)) + sum(model.step[a, b] for a, b in zip(states, states[1:]))


@given(st.integers(0, 10_000), st.integers(1, 5))
@settings(max_examples=60, deadline=None)
def test_decoding_is_the_best_of_all_paths(seed, length):
    model = random_model(seed)
    emissions = list(np.random.default_rng(seed + 1).integers(-9, 0, (length, N)))
    best = max(score(model, emissions, p) for p in product(range(N), repeat=length))
    assert score(model, emissions, chat.decode(model, emissions, None, None)) == best


@given(st.integers(0, 10_000), st.lists(st.integers(1, 6), min_size=1, max_size=6))
@settings(max_examples=100, deadline=None)
def test_pieces_give_a_path_as_good(seed, sizes):
    model = random_model(seed)
    emissions = list(np.random.default_rng(seed + 1).integers(-9, 0, (sum(sizes), N)))
    whole = score(model, emissions, chat.decode(model, emissions, None, None))
    pieces, at = [], 0
    for i, size in enumerate(sizes):
        own = emissions[at : at + size]
        alphas = model.start + own[0]
        if size > 1:
            alphas = (alphas[:, None] + chat.transfer(model, own[1:])).max(axis=0)
        pieces.append((i, chat.transfer(model, own), alphas))
        at += size
    states, at = [], 0
    for i, size in enumerate(sizes):
        before, end = chat.borders(pieces)[i]
        states += chat.decode(model, emissions[at : at + size], before, end)
        at += size
    assert score(model, emissions, states) == whole


@pytest.mark.parametrize(
    "line, speaker, rest",
    [
        ("User: hi", "user", "hi"), ("### Human:", "human", ""), ("**Assistant:** ok", "assistant", "ok"), ("[bot] x", "bot", "x"),
        ("<|im_start|>system", "system", ""), ("<|user|>q", "user", "q"), ("Q: why?", "q", "why?"), ("Answer this", "", "Answer this"),
        ("Quality: high", "", "Quality: high"), ("", "", ""), ("a: b", "a", "b"), ("- AI: x", "ai", "x"),
    ],
)
def test_markers(line, speaker, rest):
    assert chat.split_marker(line) == (speaker, rest)


@pytest.fixture(scope="module")
def model(spark):
    return chat.count_labelled(chat.as_transcripts(table(spark, SF, "conversations")).where("conv % 5 <> 0"))


def test_roles_of_held_out_conversations(spark, model):
    turns = chat.as_transcripts(table(spark, SF, "conversations")).where("conv % 5 = 0")
    raw = {(r["conv_id"], r["turn"]): (r["role"], r["text"]) for r in table(spark, SF, "conversations").where("conv_id % 5 = 0").collect()}
    got = {(r["conv"], r["turn"]): (r["role"], r["content"]) for r in chat.parse_transcripts(turns, model).collect()}
    right = sum(got.get(k) == (role, text.strip()) for k, (role, text) in raw.items())
    assert len(raw) > 80 and right >= 0.95 * len(raw)


def transcript(model, rows):
    """Brute force: all lines of a conversation decoded at once."""
    ordered = defaultdict(list)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "")
    for conv, _, text in sorted(rows, key=key):
        ordered[conv].append(text)
    out = []
    for conv, texts in ordered.items():
        lines = chat.lines_of(texts, False)
        turns = []
        for i, (line, state) in enumerate(zip(lines, chat.decode(model, [model.emission(x.seen) for x in lines], None, None))):
            role = chat.ROLES[state // 2]
            if not i or state % 2 == 0 or turns[-1][0] != role:
                turns.append((role, []))
            turns[-1][1].append(line.content)
        out += [(conv, k, role, "\n".join(c).strip(), len(c)) for k, (role, c) in enumerate(turns)]
    return sorted(out, key=str)


def test_a_conversation_over_many_pieces(spark, model):
    rows = [(7, i, f"{'User' if i % 2 == 0 else 'Assistant'}: turn {i}\nmore of {i}\n") for i in range(400)]
    rows += [(1, 0, "hello\n"), (None, 5, "Q: x"), (None, None, "A: y"), (9, 0, None), (9, 1, ""), (8, 3, "User: twice"), (8, 3, "User: twice")]
    rows += [(10, 0, "Assistant: " + "long " * 50_000)]
    frame = spark.createDataFrame([(*r, 1, "p") for r in rows], "conv long, place long, text string, piece int, role string")
    got = chat.parse_transcripts(frame, model).collect()
    pieces = chat.placed_rows(frame).where("conv = 7").select("piece").distinct().count()
    assert pieces > 3
    assert sorted(((r["conv"], r["turn"], r["role"], r["content"], r["lines"]) for r in got), key=str) == transcript(model, rows)
    for r in got:
        assert r["rendered"] == f"<|im_start|>{r['role']}\n{r['content']}<|im_end|>"


def test_long_runs_of_blanks(spark, model):
    """A million blanks between two words, and around them, take no longer than other text."""
    blanks = " \t" * 500_000
    frame = spark.createDataFrame([(1, 0, f"User: {blanks}one{blanks}two{blanks}")], "conv long, place long, text string")
    start = time.perf_counter()
    (row,) = chat.parse_transcripts(frame, model).collect()
    assert row["content"] == f"one{blanks}two" and time.perf_counter() - start < 60


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv long, place long, role string, text string")
    model = chat.count_labelled(empty)
    assert chat.parse_transcripts(empty, model).collect() == []
    odd = spark.createDataFrame([(1, 0, "narrator", "x"), (1, 1, None, "y"), (None, None, "user", None)], "conv long, place long, role string, text string")
    assert chat.parse_transcripts(odd, chat.count_labelled(odd)).count() > 0


def test_counts_are_scores():
    shown = Counter({("user/first", f, "x"): 1 for f in chat.FEATURES})
    model = chat.fit_model(Counter({"user/first": 3}), Counter({("user/first", "user/later"): 2}), shown)
    start = np.exp(model.start / chat.UNIT)
    assert start.sum() == pytest.approx(1, abs=1e-5) and start.argmax() == chat.STATES.index("user/first")
    assert np.exp(model.step / chat.UNIT).sum(axis=1) == pytest.approx(np.ones(N), abs=1e-5)
