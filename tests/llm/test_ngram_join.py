from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stridebase.llm import membership, ngram_join, words
from stridebase.llm.components import components


def shingles(text):
    w = words._WORD.findall((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute_force(docs, threshold=0.8):
    """[(id, class, links)] from all pairs."""
    sets = [shingles(t) if i is not None else set() for i, t in docs]
    near = defaultdict(list)
    for a in range(len(docs)):
        for b in range(len(docs)):
            if a != b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                near[a].append(b)
    out = []
    for a, (i, _) in enumerate(docs):
        reached, todo = {a}, [a]
        while todo:
            new = [b for b in near[todo.pop()] if b not in reached]
            reached.update(new)
            todo += new
        out.append((i, min(docs[b][0] for b in reached) if i is not None else None, len(near[a])))
    return sorted(out, key=str)


def spread(seed, number, size=120):
    """Copies of one text with a few words changed in each."""
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 10**6, size)]
    out = []
    for i in range(number):
        text = list(base)
        for at in rng.integers(0, size, int(rng.integers(0, 4))):
            text[at] = f"e{i}x{at}"
        out.append(" ".join(text))
    return out


def run(spark, docs, threshold=0.8):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in docs], "doc_id long, text string, same string, node int")
    return sorted(((r["doc_id"], r["class_id"], r["links"]) for r in ngram_join.similar_documents(df, threshold).collect()), key=str)


def test_against_brute_force(spark):
    docs = [(100 * seed + i, t) for seed in range(4) for i, t in enumerate(spread(seed, 25))]
    docs += [(5000, None), (5001, ""), (5002, ""), (5003, "!!!"), (None, docs[0][1]), (None, None)]
    docs += [(5004, "one two"), (5005, "One, two!"), (5006, "two one"), (5007, docs[3][1]), (5007, docs[3][1]), (5007, "one two")]
    docs += [(5008, "a b c d e f"), (5009, "a b c d e f g"), (5010, " ".join("a" * 500)), (5011, " ".join("a" * 90))]
    docs += [(6000, docs[1][1] + " " + " ".join(f"z{i}" for i in range(30_000)))]
    assert run(spark, docs) == brute_force(docs)


def test_blocks_of_a_large_node(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 16)
    docs = list(enumerate(spread(9, 90)))
    assert run(spark, docs) == brute_force(docs)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert ngram_join.one_of_each_class(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("threshold", [0.05, 0.2, 0.3, 0.5, 0.6, 0.7, 0.8, 0.82, 0.85, 0.9, 1.0])
def test_the_forest_suits_pairs_at_the_threshold(threshold):
    trees, depth = ngram_join.forest_shape(threshold)
    assert ngram_join.chance(threshold, depth, trees) >= ngram_join.RECALL
    if trees == ngram_join.TREES:  # the longest prefix that does
        assert depth == ngram_join.DEPTH or ngram_join.chance(threshold, depth + 1) < ngram_join.RECALL
    else:
        assert depth == 1


def test_the_forest_keeps_documents_apart_that_share_passages():
    trees, depth = ngram_join.forest_shape(0.8)
    assert ngram_join.chance(0.3, depth, trees) < 0.03 and ngram_join.chance(0.4, depth, trees) < 0.15


@pytest.mark.parametrize("threshold", [0, -1, 1.1, float("nan")])
def test_thresholds_that_make_no_sense(spark, threshold):
    with pytest.raises(ValueError):
        ngram_join.similar_documents(spark.createDataFrame([], "doc_id long, text string"), threshold)


@pytest.mark.parametrize("threshold", [0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])
def test_recall_at_every_threshold(spark, threshold):
    """60 pairs just at the threshold: 100 + 4 words, of which a run is shared."""
    docs, size = [], 200
    for i in range(60):
        shared = round(2 * size * threshold / (1 + threshold)) + 1
        common = [f"c{i}x{j}" for j in range(shared + 4)]
        for side in range(2):
            docs.append((2 * i + side, " ".join(common + [f"s{i}x{side}x{j}" for j in range(size - shared)])))
    found = run(spark, docs, threshold)
    assert found == brute_force(docs, threshold)
    assert sum(links for _, _, links in found) == 120


def test_copies_do_not_hide_pairs_at_the_threshold(spark):
    base = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join([*base, f"end{i}"])) for i in range(150)]  # very similar copies
    pair = [f"v{i}" for i in range(104)]
    docs += [(500, " ".join(pair[:94])), (501, " ".join(pair[:4] + pair[10:]))]
    assert run(spark, docs) == brute_force(docs)


def test_without_a_filter(spark, monkeypatch):
    """Too many keys for a bounded filter: the same rows by joins alone."""
    docs = list(enumerate(spread(5, 20) + ["alone"])) + [(3, "alone")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    with_filter = sorted(map(tuple, ngram_join.one_of_each_class(df).collect()))
    monkeypatch.setattr(membership, "MOST_BITS", 1)
    assert sorted(map(tuple, ngram_join.one_of_each_class(df).collect())) == with_filter


def test_filters_hold_all_keys(spark):
    keys = spark.range(0, 200_000, 2).selectExpr("xxhash64(id) as key")
    maybe = membership.possible_members(keys)
    found = spark.range(200_000).select((F.col("id") % 2 == 0).alias("even"), maybe(F.xxhash64("id")).alias("held"))
    counts = {(r["even"], r["held"]): r["count"] for r in found.groupBy("even", "held").count().collect()}
    assert counts[True, True] == 100_000 and (True, False) not in counts
    assert counts[False, True] < 5_000
    none = membership.possible_members(spark.range(0).selectExpr("id as key"))
    assert spark.range(100).where(none(F.xxhash64("id"))).count() == 0


def test_sketches_miss_no_similar_pair():
    rng = np.random.default_rng(5)
    least = ngram_join.least_agreement(0.8)
    agreed = rng.binomial(ngram_join.SKETCH, 0.8, 100_000)
    assert (agreed < least).mean() < 1e-4 and least > 0.6 * ngram_join.SKETCH


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (800, 100, 100))
    left, right = (words.minhash(np.concatenate([common, x]), ngram_join.MULTIPLIERS) for x in (a, b))
    assert abs((left == right).mean() - 0.8) < 0.12


@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=20), min_size=1, max_size=8), st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=1, max_size=8))
@settings(max_examples=100, deadline=None)
def test_shared_shingles(left, right):
    arrays = [[np.array(sorted(s), np.uint64) for s in side] for side in (left, right)]
    got = ngram_join.shared_shingles(*arrays)
    assert got.tolist() == [[len(a & b) for b in right] for a in left]


def test_one_of_each_class(spark):
    docs = [(i, t, "extra") for i, t in enumerate(spread(1, 10) + ["alone in here with some words", None, None])]
    docs += [(11, None, "again"), (None, None, "n"), (None, None, "n")]
    df = spark.createDataFrame(docs, "doc_id long, text string, gone string")
    kept = ngram_join.one_of_each_class(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 2
    least = {c for i, c, _ in brute_force([d[:2] for d in docs]) if i is not None}
    assert sorted(i for i in ids if i is not None) == sorted(least) and len(least) < 12


def test_rows_that_repeat_an_id_are_judged_by_their_own_text(spark):
    a, b, c = ([" ".join([f"{name}{i}" for i in range(60)] + end) for end in ([], ["more"])] for name in "abc")
    docs = [(1, a[0]), (5, a[1]), (5, b[0]), (5, c[0]), (5, c[0]), (5, c[1]), (7, b[1]), (8, None), (8, None), (8, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = [tuple(r) for r in ngram_join.one_of_each_class(df).collect()]
    assert (1, a[0]) in kept and (5, a[1]) not in kept  # a copy of another id's text goes
    assert (5, b[0]) in kept and (7, b[1]) not in kept  # another text of that id stays, and stands for its class
    assert len([d for d in kept if d in ((5, c[0]), (5, c[1]))]) == 1
    assert len(kept) == 5 and (8, None) in kept and (8, "") in kept


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (70, 2))] + [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 400)]
    rows = [*edges, (None, 1), (1, None), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    assert got == {x: find(x) for x in list(parent) if find(x) != x}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
