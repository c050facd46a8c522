import numpy as np
import pytest

from stridebase.llm import kdtree
from pyspark.sql import functions as F


def brute_force(rows, queries, k):
    out, seen = [], set()
    for q, x in queries:
        if q in seen:
            continue
        seen.add(q)
        found = [(-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q and len(y) == len(x)]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def run(spark, rows, queries, k=5):
    frames = [spark.createDataFrame([(i, x, 1, "s") for i, x in r], "id long, vector array<long>, shard int, dim string") for r in (rows, queries)]
    return sorted(tuple(r) for r in kdtree.nearest(*frames, k).collect())


@pytest.mark.parametrize("cell, part, scale", [(2048, 1 << 20, 100), (40, 1 << 20, 100), (40, 2000, 2), (40, 1 << 20, 10**9)])
def test_against_brute_force(spark, monkeypatch, cell, part, scale):
    monkeypatch.setattr(kdtree, "CELL", cell)
    monkeypatch.setattr(kdtree, "PART", part)
    monkeypatch.setattr(kdtree, "ASKING", 700)
    rng = np.random.default_rng(scale % 1000)
    rows = [(i, [int(v) for v in rng.integers(-scale, scale, 6)]) for i in range(300)]
    rows += [(1000 + i, [1, 2, 3, 4, 5, 6]) for i in range(100)]  # a hot vector
    rows += [(2000 + i, [7, 8]) for i in range(4)] + [(7, [1] * 6), (7, [1] * 6)]
    rows += [(1000, [1, 2, 3, 4, 5, 6])] * 9  # more copies of one id than anyone needs
    queries = [r for r in rows if r[0] % 10 == 0] + [rows[0]]
    assert run(spark, rows, queries) == brute_force(rows, queries, 5)


@pytest.mark.parametrize("leaf", [1, 4, 64])
def test_tree_against_brute_force(monkeypatch, leaf):
    monkeypatch.setattr(kdtree, "LEAF", leaf)
    rng = np.random.default_rng(leaf)
    vectors = rng.integers(-9, 9, (500, 3))
    vectors[:100] = vectors[0]
    ids = rng.permutation(500)
    queries, floors = rng.integers(-9, 9, (40, 3)), np.full(40, kdtree._LEAST)
    floors[20:] = 30
    who, scores, found, _ = kdtree.search(kdtree.build_tree(ids, vectors, 7), np.arange(40), queries, floors, 7)
    for q in range(40):
        all_of = sorted((-int(s), int(i)) for s, i in zip(vectors @ queries[q], ids) if i != q and s >= floors[q])
        assert sorted((-s, i) for s, i in zip(scores[who == q].tolist(), found[who == q].tolist())) == all_of[:7]


def test_scores_beyond_a_long(spark):
    rows = [(i, [10**12 * (i - 2), 10**12]) for i in range(5)]
    got = run(spark, rows, [(4, [10**12 * 2, 10**12])], 9)
    assert got == [(4, 1, 2, 2**63 - 1), (4, 2, 3, 2**63 - 1), (4, 3, 0, -(2**63)), (4, 4, 1, -(2**63))]


def test_few_and_no_rows(spark):
    assert run(spark, [], []) == []
    assert run(spark, [(1, [1, 2])], [(1, [1, 2])]) == []
    assert run(spark, [(1, [1, 2]), (2, [3, 4])], [(1, [1, 2])]) == [(1, 1, 2, 11)]
    assert run(spark, [(1, [1, 2])], []) == []


def test_quantised(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []), (None, [1.0]), (7, [0.001, -0.001])]
    got = kdtree.quantised(spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, id int")).collect()
    assert sorted((r["id"], r["vector"]) for r in got) == [(1, [128, -128]), (7, [0, -1])]
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    vectors = kdtree.quantised(empty)
    assert kdtree.nearest(vectors, vectors.where(F.col("id") % 50 == 0)).collect() == []


def test_boxes_are_tight_and_leaves_small():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-50, 50, (1000, 4))
    tree = kdtree.build_tree(np.arange(1000), vectors, 5)
    leaves = tree.children[:, 0] < 0
    assert sum(end - start for start, end in tree.ranges[leaves]) == 1000
    assert all(end - start <= kdtree.LEAF for start, end in tree.ranges[leaves])
    for node, (start, end) in enumerate(tree.ranges):
        inside = tree.vectors[start:end]
        assert (tree.low[node] == inside.min(axis=0)).all() and (tree.high[node] == inside.max(axis=0)).all()


def test_search_opens_nothing_below_the_floor():
    vectors = np.array([[i, 0] for i in range(1000)])
    tree = kdtree.build_tree(np.arange(1000), vectors, 5)
    who, scores, ids, visited = kdtree.search(tree, np.array([-1]), np.array([[1, 0]]), np.array([998]), 5)
    assert (who.tolist(), scores.tolist(), ids.tolist(), visited) == ([0, 0], [999, 998], [999, 998], 1)
    assert kdtree.search(tree, np.array([-1]), np.array([[1, 0]]), np.array([1000]), 5)[3] == 0


def test_few_cells_and_leaves_are_asked_where_vectors_lie_in_groups(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "CELL", 50)
    rng = np.random.default_rng(3)
    centres = np.ones((1, 1), dtype=np.int64) * 1000
    for _ in range(4):  # orthogonal, and halved by every component but the first
        centres = np.block([[centres, centres], [centres, -centres]])
    points = np.concatenate([c + rng.integers(-20, 20, (100, 16)) for c in centres])
    frame = spark.createDataFrame([(i, v.tolist(), 16) for i, v in enumerate(points)], "id long, vector array<long>, dim int")
    dealt, boxes = kdtree.deal_into_cells(frame, 5)
    assert len(boxes[16][0]) == 32 and dealt.groupBy("cell").count().agg({"count": "max"}).first()[0] < 100
    asked = kdtree.ask_home(frame, boxes).withColumn("floor", F.lit(15_000_000).cast("long"))
    reached = kdtree.ask_others(asked, boxes).agg(F.max(F.size("others"))).first()[0]
    assert reached <= 3  # of 31
    tree = kdtree.build_tree(np.arange(1600), points, 5)
    floors = np.full(1600, kdtree._LEAST)
    assert kdtree.search(tree, np.arange(1600), points, floors, 5)[3] < 1600 * 6  # of 32 leaves each


def test_cells_are_even_and_split_by_value():
    rng = np.random.default_rng(5)
    vectors = rng.integers(0, 100, (1000, 3))
    cells = kdtree.cells_of(vectors, kdtree.learn_splits(vectors, 10))
    numbers = np.bincount(cells)
    assert len(numbers) == 10 and numbers.min() > 60 and numbers.max() < 140
    assert kdtree.learn_splits(np.ones((9, 2)), 4) == [(0,)]
