"""Exact top-k by inner product: KD-trees over shards of one space, searched best-first in blocks of queries.

Median splits of the widest dimension, learnt from a bounded sample, deal all vectors into cells with
tight bounding boxes; the vectors of a cell, or a part of them if it is large, are one shard with a KD-tree of
its own. A box gives the largest inner product that any vector in it can have. A query first asks the cell with the best
bound, which yields a k-th score to start from, and then only those other cells whose bound reaches it.
In a shard it goes down to its best leaf, opens no node whose bound is below its k-th score, and visits the leaves
left from the best bound down, in batches that double, while its k-th score rises.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stridebase.llm.tables import cut_lineage

CELL = 2048  # vectors in a cell, about, as long as the boxes stay within their bound
BOXES = 8 << 20  # bytes of all boxes, which every task that deals queries holds
SAMPLED = 16  # sampled vectors per cell, from which the splits are learnt
PART = 8 << 20  # bytes of vectors in a shard
ASKING = 8 << 20  # bytes of queries that meet a shard in one task
BLOCK = 512  # queries searched at once
LEAF = 64
_EXACT = float(1 << 53)  # whole numbers that a double holds
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _numeric(*arrays: np.ndarray) -> list[np.ndarray]:
    """All as doubles if every product of the first with the others is exact in them, or else as whole numbers of any size."""
    most = [float(np.abs(a.astype(np.float64)).max(initial=0)) for a in arrays]
    kind = np.float64 if most[0] * max(most[1:]) * max(1, arrays[0].shape[1]) < _EXACT else object
    return [a.astype(kind) for a in arrays]


def _long(scores: np.ndarray) -> np.ndarray:
    """Scores beyond the range of a long count as its end."""
    return (np.clip(scores, _LEAST, _MOST) if scores.dtype == object else scores).astype(np.int64)


def _bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest inner product of each query with any point of each box."""
    return _long(np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T)


def fewest(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Positions of the rows, ordered by vector and id, that can be among the best ``k`` of a query of another id:
    of equal vectors the ``2 k`` smallest ids, each of them at most ``k`` times."""
    order = np.lexsort((ids, *vectors.T[::-1]))

    def place_in_run(rows: np.ndarray, by_id: bool) -> np.ndarray:
        new = (vectors[rows][1:] != vectors[rows][:-1]).any(axis=1)
        if by_id:
            new |= ids[rows][1:] != ids[rows][:-1]
        starts = np.flatnonzero(np.append(True, new)[: len(rows)])
        return np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))

    order = order[place_in_run(order, True) < k]
    return order[place_in_run(order, False) < 2 * k]


@dataclass
class Tree:
    """Nodes with tight boxes and two children (-1: a leaf), each over a range of the vectors."""

    low: np.ndarray
    high: np.ndarray
    children: np.ndarray
    ranges: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray


def build_tree(ids: np.ndarray, vectors: np.ndarray, k: int) -> Tree:
    """Median splits of the widest dimension, down to ``LEAF`` vectors or equal ones."""
    kept = fewest(ids, vectors, k)
    ids, vectors = ids[kept], vectors[kept]
    rows = np.arange(len(ids))
    low, high, children, ranges = [], [], [], []

    def add(start: int, end: int) -> int:
        inside = vectors[rows[start:end]]
        low.append(inside.min(axis=0))
        high.append(inside.max(axis=0))
        children.append([-1, -1])
        ranges.append((start, end))
        return len(ranges) - 1

    open_nodes = [add(0, len(rows))] if len(rows) else []
    while open_nodes:
        node = open_nodes.pop()
        start, end = ranges[node]
        widest = int(np.argmax(high[node].astype(np.float64) - low[node]))
        if end - start <= LEAF or (high[node] == low[node]).all():
            continue
        middle = (end - start) // 2
        rows[start:end] = rows[start:end][np.argpartition(vectors[rows[start:end], widest], middle)]
        children[node] = [add(start, start + middle), add(start + middle, end)]
        open_nodes += children[node]
    shape = (len(ranges), vectors.shape[1])
    boxes = [np.array(x, dtype=np.int64).reshape(shape) for x in (low, high)]
    return Tree(*boxes, np.array(children).reshape(-1, 2), np.array(ranges).reshape(-1, 2), ids[rows], vectors[rows])


def _groups(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Every key with the positions that hold it."""
    order = np.argsort(keys, kind="stable")
    starts = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1])[: len(keys)])
    for where in np.split(order, starts[1:]) if len(keys) else ():
        yield int(keys[where[0]]), where


def search(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Positions of queries, scores and ids of what the queries find: of each its best ``k`` with scores
    of at least its floor; and how many leaves were visited, counted per query.

    Ties go to the smaller id, so a node whose bound equals the k-th score is still opened.
    """
    none = np.empty(0, np.int64)
    best, visited = (none, none, none), 0  # query, score, id
    if not len(tree.ids) or not len(queries):
        return *best, visited
    floors = floors.copy()
    queries, low, high, vectors = _numeric(queries, tree.low, tree.high, tree.vectors)

    def visit(who: np.ndarray, leaves: np.ndarray) -> None:
        nonlocal best, visited
        visited += len(who)
        found = [best]
        for leaf, where in _groups(leaves):
            start, end = tree.ranges[leaf]
            asks, ids = who[where], tree.ids[start:end]
            scores = _long(queries[asks] @ vectors[start:end].T)
            rows, columns = np.nonzero((scores >= floors[asks][:, None]) & (ids[None, :] != query_ids[asks][:, None]))
            found.append((asks[rows], scores[rows, columns], ids[columns]))
        q, score, vec = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((vec, ~score, q))
        q, score, vec = q[order], score[order], vec[order]
        starts = np.flatnonzero(np.append(True, q[1:] != q[:-1])[: len(q)])
        place = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
        last = place == k - 1
        floors[q[last]] = np.maximum(floors[q[last]], score[last])
        best = (q[place < k], score[place < k], vec[place < k])

    # Down to the best leaf.
    everyone = np.arange(len(queries))
    live = everyone[_bounds(queries, low[:1], high[:1])[:, 0] >= floors]
    at = np.zeros(len(queries), dtype=np.int64)
    going = live[tree.children[at[live], 0] >= 0]
    while len(going):
        for node, where in _groups(at[going]):
            pair = tree.children[node]
            at[going[where]] = pair[np.argmax(_bounds(queries[going[where]], low[pair], high[pair]), axis=1)]
        going = going[tree.children[at[going], 0] >= 0]
    visit(live, at[live])

    # All nodes whose bound reaches the floor, level by level.
    who, nodes = live, np.zeros(len(live), dtype=np.int64)
    leaves = [(none, none, none)]
    bounds = _bounds(queries[who], low[:1], high[:1])[:, 0]
    while len(who):
        ends = tree.children[nodes, 0] < 0
        leaves.append((who[ends], nodes[ends], bounds[ends]))
        who, nodes = who[~ends], nodes[~ends]
        opened = [(none, none, none)]
        for node, where in _groups(nodes):
            asks, pair = who[where], tree.children[node]
            both = _bounds(queries[asks], low[pair], high[pair])
            rows, columns = np.nonzero(both >= floors[asks][:, None])
            opened.append((asks[rows], pair[columns], both[rows, columns]))
        who, nodes, bounds = (np.concatenate(x) for x in zip(*opened))
    who, nodes, bounds = (np.concatenate(x) for x in zip(*leaves))
    new = nodes != at[who]
    who, nodes, bounds = who[new], nodes[new], bounds[new]

    # The leaves left, best bound first: one, two, four and so on of each query.
    order = np.lexsort((~bounds, who))
    who, nodes, bounds = who[order], nodes[order], bounds[order]
    starts = np.flatnonzero(np.append(True, who[1:] != who[:-1])[: len(who)])
    place = np.arange(len(who)) - np.repeat(starts, np.diff(np.append(starts, len(who))))
    batch = np.frexp(place + 1)[1]
    for step in range(1, int(batch.max(initial=0)) + 1):
        now = np.flatnonzero((batch == step) & (bounds >= floors[who]))
        if len(now):
            visit(who[now], nodes[now])
    return *best, visited


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    arrays = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [a.flatten().to_numpy(zero_copy_only=False) for a in arrays if len(a)]
    return np.concatenate(flat).reshape(len(column), -1) if flat else np.empty((0, 1), np.int64)


_FOUND = "query_id long, vec_id long, score long"


def _search_shards(k: int) -> Callable[[pa.Table], pa.Table]:
    """All rows of a shard, its vectors and the queries that come to it -> what they find."""

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks")
        data, queries = table.filter(pc.invert(asks)), table.filter(asks)
        out = [(np.empty(0, np.int64),) * 3]
        if len(data) and len(queries):
            tree = build_tree(data.column("id").to_numpy(), _matrix(data.column("vector")), k)
            for start in range(0, len(queries), BLOCK):
                part = queries.slice(start, BLOCK)
                ids = part.column("id").to_numpy()
                who, scores, found, _ = search(tree, ids, _matrix(part.column("vector")), part.column("floor").to_numpy(), k)
                out.append((ids[who], found, scores))
        columns = [pa.array(np.concatenate(x), pa.int64()) for x in zip(*out)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    return run


def learn_splits(sample: np.ndarray, cells: int) -> list[tuple]:
    """Splits (dimension, least value of the second half, node of the first half, node of the second half) into about ``cells``
    cells of equal numbers of the sample, and ``(cell,)`` for a cell. The first entry is the root. A split is at the median, or
    in a gap of a quarter of the spread if one lies within an eighth of the rows from it."""
    nodes: list[tuple] = [()]
    open_nodes, number = [(0, np.arange(len(sample)), cells)], 0
    while open_nodes:
        node, rows, wanted = open_nodes.pop()
        inside = sample[rows]
        spread = inside.max(axis=0).astype(np.float64) - inside.min(axis=0) if len(rows) else np.zeros(1)
        widest = int(np.argmax(spread))
        if wanted < 2 or spread[widest] == 0:
            nodes[node] = (number,)
            number += 1
            continue
        values = np.sort(inside[:, widest])
        changes = np.flatnonzero(values[1:] != values[:-1]) + 1
        away = np.abs(changes - len(rows) * (wanted // 2) / wanted)
        gaps = values[changes].astype(np.float64) - values[changes - 1]
        wide = (away <= len(rows) / 8) & (gaps >= spread[widest] / 4)
        cut = values[changes[np.argmax(np.where(wide, gaps, -1)) if wide.any() else np.argmin(away)]]
        second = inside[:, widest] >= cut
        nodes[node] = (widest, int(cut), len(nodes), len(nodes) + 1)
        open_nodes += [(len(nodes), rows[~second], wanted // 2), (len(nodes) + 1, rows[second], wanted - wanted // 2)]
        nodes += [(), ()]
    return nodes


def cells_of(vectors: np.ndarray, splits: list[tuple]) -> np.ndarray:
    """The cell of each vector."""
    cells = np.zeros(len(vectors), dtype=np.int32)
    open_nodes = [(0, np.arange(len(vectors)))]
    while open_nodes:
        node, rows = open_nodes.pop()
        if len(splits[node]) == 1:
            cells[rows] = splits[node][0]
        elif len(rows):
            dimension, cut, first, other = splits[node]
            second = vectors[rows, dimension] >= cut
            open_nodes += [(first, rows[~second]), (other, rows[second])]
    return cells


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column(batch.schema.get_field_index("dim")).to_numpy(zero_copy_only=False)
    for dim, where in _groups(dims):
        yield dim, batch.take(pa.array(where))


def _deal(splits: dict[int, list[tuple]], k: int) -> Callable:
    """id, vector, dim -> the same with their cell, less the equal vectors of a batch that nobody needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_length(batch):
                vectors = _matrix(part.column(1))
                kept = fewest(part.column(0).to_numpy(), vectors, k)
                cells = cells_of(vectors[kept], splits[dim]) if dim in splits else np.zeros(len(kept), np.int32)
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(kept)).columns, pa.array(cells)], names=["id", "vector", "dim", "cell"])

    return run


def _task_boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One box per cell that a task holds rows of."""
    held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for dim, part in _by_length(batch):
            vectors = _matrix(part.column(1))
            for cell, where in _groups(part.column(3).to_numpy()):
                low, high = vectors[where].min(axis=0), vectors[where].max(axis=0)
                old = held.get((dim, cell), (low, high))
                held[dim, cell] = np.minimum(low, old[0]), np.maximum(high, old[1])
    for (dim, cell), (low, high) in held.items():
        yield pa.RecordBatch.from_pylist([{"dim": dim, "cell": cell, "low": low.tolist(), "high": high.tolist()}], _BOX)


_BOX = pa.schema([("dim", pa.int32()), ("cell", pa.int32()), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64()))])
Boxes = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # cells, low and high by length


def _ask(boxes: Boxes, first: bool) -> Callable:
    """Queries with their ``home``, the cell of the best bound, or with all ``others`` whose bound reaches the floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_length(batch):
                known = boxes.get(dim, (np.zeros(1, np.int32),))
                for start in range(0, len(part), BLOCK):
                    rows = part.slice(start, BLOCK)
                    if len(known) == 1:
                        bounds = np.zeros((len(rows), 1), np.int64)
                    else:
                        bounds = _bounds(*_numeric(_matrix(rows.column(1)), *known[1:]))
                    if first:
                        yield rows.append_column("home", pa.array(known[0][np.argmax(bounds, axis=1)]))
                        continue
                    home, floor = (rows.column(rows.schema.get_field_index(c)).to_numpy() for c in ("home", "floor"))
                    reached = (bounds >= floor[:, None]) & (known[0][None, :] != home[:, None])
                    others = [known[0][r].tolist() for r in reached]
                    yield rows.append_column("others", pa.array(others, pa.list_(pa.int32())))

    return run


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """``id``, ``vector``: floor(scale * x) of every component as whole numbers. Rows with a NULL
    id, a NULL or empty vector, or a component that is NULL, NaN or infinite are left out."""
    x = F.transform(F.col(vector_column), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & (F.size(vector_column) > 0) & fine)
    return rows.select(F.col(id_column).cast("long").alias("id"), F.transform(x, lambda c: F.floor(scale * c).cast("long")).alias("vector"))


_DEALT = "id long, vector array<long>, dim int, cell int"


def deal_into_cells(vectors: DataFrame, k: int) -> tuple[DataFrame, Boxes]:
    """``id``, ``vector``, ``dim`` -> the stored rows with their ``cell``, and the boxes of the cells of every length that has several.

    The number of rows per length (one row per length on the driver) gives the number of cells of each, as many as keep all boxes within
    ``BOXES`` bytes; the splits are learnt from ``SAMPLED`` rows per cell, chosen by a hash.
    """
    lengths = {r["dim"]: r["count"] for r in vectors.groupBy("dim").count().collect()}
    rows = sum(lengths.values())
    cells = {dim: min(n // CELL, int(BOXES * n / rows / (16 * dim))) for dim, n in lengths.items()}
    cells = {dim: n for dim, n in cells.items() if n > 1}
    splits = {}
    if cells:
        spark = vectors.sparkSession
        share = [(dim, min(1.0, SAMPLED * n / lengths[dim])) for dim, n in cells.items()]
        shares = spark.createDataFrame(share, "dim int, share double")
        lot = F.shiftrightunsigned(F.xxhash64("id", F.monotonically_increasing_id()), 11) / float(1 << 53)
        sample = vectors.withColumn("lot", lot).join(F.broadcast(shares), "dim").where(F.col("lot") < F.col("share")).select("dim", "vector").toArrow()
        for dim, n in cells.items():
            splits[dim] = learn_splits(_matrix(sample.filter(pc.equal(sample.column("dim"), dim)).column("vector")), n)
    dealt = cut_lineage(vectors.select("id", "vector", "dim").mapInArrow(_deal(splits, k), _DEALT), "cells")
    if not cells:
        return dealt, {}
    several = dealt.where(F.col("dim").isin(list(cells)))
    corners = several.mapInArrow(_task_boxes, "dim int, cell int, low array<long>, high array<long>")
    by_place = corners.select("dim", "cell", F.posexplode(F.arrays_zip("low", "high")).alias("place", "x"))
    least = by_place.groupBy("dim", "cell", "place").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    whole = least.groupBy("dim", "cell").agg(F.array_sort(F.collect_list(F.struct("place", "low", "high"))).alias("b"))
    found = whole.select("dim", "cell", F.col("b.low").alias("low"), F.col("b.high").alias("high")).orderBy("dim", "cell").toArrow()
    boxes = {}
    for dim in cells:
        of = found.filter(pc.equal(found.column("dim"), dim))
        boxes[dim] = (of.column("cell").to_numpy(), _matrix(of.column("low")), _matrix(of.column("high")))
    return dealt, boxes


def ask_home(asked: DataFrame, boxes: Boxes) -> DataFrame:
    """``id``, ``vector``, ``dim`` -> the same with ``home``, the cell that can have the best vector."""
    return asked.mapInArrow(_ask(boxes, True), "id long, vector array<long>, dim int, home int")


def ask_others(asked: DataFrame, boxes: Boxes) -> DataFrame:
    """``id``, ``vector``, ``dim``, ``home``, ``floor`` -> the same with ``others``, all other cells whose bound reaches the floor."""
    return asked.mapInArrow(_ask(boxes, False), "id long, vector array<long>, dim int, home int, floor long, others array<int>")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id``, ``rank`` (int, from 1), ``vec_id``, ``score``: per query the ``k`` greatest inner products.

    Both tables have ``id`` and ``vector`` (array of long, not empty), as from :func:`quantised`.
    A query is not its own neighbour, ties go to the smaller id, and a query with fewer than ``k``
    candidates gets all. A score beyond the range of long counts as its end. Vectors meet those of their own length. Rows that repeat an id are
    vectors of their own; a query that repeats an id is answered once. An empty table gives no rows.

    Cells are dealt by place, so that most queries need few of them where vectors lie in groups. A cell with more than ``PART`` bytes
    of vectors, as one that holds the same vector very often, is several shards, dealt by a hash; more than ``ASKING`` bytes of queries
    for one cell are several blocks.
    """
    with_length = lambda df: df.select("id", "vector", F.size("vector").alias("dim"))
    dealt, boxes = deal_into_cells(with_length(vectors), k)
    asked = cut_lineage(ask_home(with_length(queries.dropDuplicates(["id"])), boxes), "queries")

    def pieces(rows: DataFrame, size: int, name: str) -> DataFrame:
        """How many pieces of ``size`` bytes the rows of each cell are."""
        return rows.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) * F.col("dim") * 8 / size).cast("int").alias(name))

    salt = F.monotonically_increasing_id()  # rows that repeat an id do not meet in one shard
    parts = cut_lineage(pieces(dealt, PART, "parts"), "parts")
    placed = dealt.withColumn("lot", F.xxhash64("id", salt)).join(parts, ["dim", "cell"])
    placed = placed.select("id", "vector", "dim", "cell", F.pmod("lot", "parts").cast("int").alias("part"))

    def meet(asks: DataFrame) -> DataFrame:
        """The best of every query in every shard of the cell it asks."""
        blocks = cut_lineage(pieces(asks, ASKING, "blocks"), "blocks")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        data = placed.join(blocks, ["dim", "cell"]).withColumn("block", every("blocks")).drop("blocks")
        data = data.withColumns({"asks": F.lit(False), "floor": F.lit(_LEAST)})
        block = F.pmod(F.xxhash64("id", F.lit(1)), "blocks").cast("int")
        come = asks.join(blocks, ["dim", "cell"]).join(parts, ["dim", "cell"])
        come = come.select("id", "vector", "dim", "cell", every("parts").alias("part"), block.alias("block"), F.lit(True).alias("asks"), "floor")
        return data.unionByName(come).groupBy("dim", "cell", "part", "block").applyInArrow(_search_shards(k), _FOUND)

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    best = lambda found: found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
    at_home = asked.select("id", "vector", "dim", F.col("home").alias("cell"), F.lit(_LEAST).alias("floor"))
    first = best(meet(at_home))
    if not boxes:
        return first
    first = cut_lineage(first, "first")
    floors = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), "score")
    carried = asked.join(floors, "id", "left").select("id", "vector", "dim", "home", F.coalesce("score", F.lit(_LEAST)).alias("floor"))
    others = cut_lineage(ask_others(carried, boxes), "others")
    others = others.select("id", "vector", "dim", F.explode("others").alias("cell"), "floor")
    return best(first.drop("rank").unionByName(meet(others)))
