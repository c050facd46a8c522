"""Similar documents by the Jaccard similarity of their word shingles, through an LSH forest.

A tree of the forest orders documents by up to ``DEPTH`` MinHash values; its nodes are runs that share a
prefix. The join starts from the longest prefix and shortens it until a pair at the threshold, which is the
hardest to find, shares a node in some tree with a chance of ``RECALL``; thresholds at which not even
one value is short enough get more trees. An average over the pairs of a table would not do: many very
similar copies would hide the pairs that a long prefix misses. Long prefixes in many trees keep
documents apart that only share some passages.

Documents with equal shingle sets take part once. A node is cut into blocks, and a task compares one
pair of blocks, so pairs are never rows. First the tasks compare sketches of ``SKETCH`` values, of one byte
each; only documents with a partner whose sketch is near enough (a similar pair fails with a chance
below one in 100,000) are read again, and their shingles compared exactly by sparse counts and a dense
product. A task returns, per document, the number of documents it links to, and one link towards its group.
A pair that shares nodes of several trees is compared in the first of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridebase.llm.components import components
from stridebase.llm.membership import PossibleMembers, possible_members
from stridebase.llm.tables import cut_lineage, fresh_name
from stridebase.llm.words import minhash, rows_of, seeds, shingle_sequence, word_hashes

TREES, DEPTH = 33, 12
RECALL = 0.9999
SEED = 7
SKETCH = 128  # values of a sketch, one byte each
SPREAD = 4.5  # standard deviations by which a sketch may fall short of the threshold
BLOCK_DOCS, BLOCK_WORDS = 1024, 1 << 20  # in one block of a node
MULTIPLIERS = seeds(TREES * DEPTH, SEED)

_SIGNED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text_hash", T.LongType()),
        T.StructField("same", T.BinaryType()),
        T.StructField("words", T.LongType()),
        T.StructField("nodes", T.BinaryType()),
        T.StructField("sketch", T.BinaryType()),
    ]
)


def chance(similarity: float, depth: int, trees: int = TREES) -> float:
    """That two documents share a node at this depth in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def fitting_depth(threshold: float) -> int:
    """The longest prefix at which pairs at the threshold are found with a chance of ``RECALL``, or 1.

    Pairs above the threshold are found with a greater chance. What else is in a table does not matter.
    """
    return next((d for d in range(DEPTH, 1, -1) if chance(threshold, d) >= RECALL), 1)


def forest_shape(threshold: float) -> tuple[int, int]:
    """Trees and depth that find pairs at the threshold with a chance of ``RECALL``."""
    if not 0 < threshold <= 1:
        raise ValueError(f"the threshold must be above 0 and at most 1, not {threshold}")
    depth = fitting_depth(threshold)
    if chance(threshold, depth) >= RECALL:
        return TREES, depth
    return math.ceil(math.log(1 - RECALL) / math.log(1 - threshold)), depth


def least_agreement(threshold: float) -> int:
    """Values of two sketches that agree at least, if the documents are similar."""
    return max(0, math.floor(SKETCH * threshold - SPREAD * math.sqrt(SKETCH * threshold * (1 - threshold))))


def _digest(shingles: np.ndarray) -> bytes:
    """Equal for equal shingle sets."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _nodes(values: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """The key of a document's node in every tree, from its MinHash values."""
    keys = np.arange(1, trees + 1, dtype=np.uint64)
    for column in values[: trees * depth].reshape(trees, depth).T:
        keys = (keys ^ column) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys


def _sign(trees: int, depth: int):
    """(id, text hash, text) -> id, text hash, digest of the shingle set, number of words, nodes, sketch; NULL without words."""
    multipliers = seeds(max(trees * depth, SKETCH, len(MULTIPLIERS)), SEED)[: max(trees * depth, SKETCH)]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in rows_of(batch, 2):
                same, number, nodes, sketches = [], [], [], []
                for text in texts:
                    words = word_hashes(text)
                    number.append(len(words))
                    if not len(words):
                        for column in (same, nodes, sketches):
                            column.append(None)
                        continue
                    shingles = np.unique(shingle_sequence(words))
                    values = minhash(shingles, multipliers)
                    same.append(_digest(shingles))
                    nodes.append(_nodes(values, trees, depth).tobytes())
                    sketches.append(values[:SKETCH].astype(np.uint8).tobytes())
                keys = [batch.column(c).slice(start, len(texts)) for c in (0, 1)]
                binary = [pa.array(c, pa.binary()) for c in (nodes, sketches)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(same, pa.binary()), pa.array(number), *binary], names=_SIGNED.names)

    return sign


_ROOTED = T.StructType([T.StructField(c, T.LongType()) for c in ("number", "words", "tree", "node")])


def _rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, words, nodes) -> a row per tree."""
    for batch in batches:
        nodes = [np.frombuffer(n, np.int64) for n in batch.column(2).to_pylist()]
        trees = [len(n) for n in nodes]
        repeated = [np.repeat(batch.column(c).to_numpy(), trees) for c in (0, 1)]
        tree = np.concatenate([np.arange(n) for n in trees]) if trees else np.zeros(0, np.int64)
        columns = [*repeated, tree, np.concatenate(nodes) if nodes else np.zeros(0, np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_ROOTED.names)


def _blocks(forest: DataFrame) -> DataFrame:
    """``number``, ``tree``, ``node``, its ``block``, and each pair of blocks (``low``, ``high``) it takes part in.

    Nodes with the same members are compared once, in the first tree that has them.
    """
    digest = F.xxhash64("number")
    members = [
        F.count(F.lit(1)).alias("n"),
        F.sum("words").alias("words"),
        F.bit_xor(digest).alias("x"),
        F.sum(digest.bitwiseAND(F.lit((1 << 40) - 1))).alias("y"),
    ]
    nodes = forest.groupBy("node", "tree").agg(*members)
    parts = F.ceil(F.greatest(F.col("n") / BLOCK_DOCS, F.col("words") / BLOCK_WORDS)).cast("int")
    kept = nodes.groupBy("n", "words", "x", "y").agg(F.min(F.struct("tree", "node")).alias("k"))
    member = forest.join(kept.select("k.node", parts.alias("parts")), "node")
    block = F.pmod(F.xxhash64("number", F.lit(SEED)), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return (
        member.select("number", "tree", "node", block.alias("block"), "parts")
        .select("number", "tree", "node", "block", other.alias("other"))
        .select("number", "tree", "node", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )


class _Pair:
    """A pair of blocks of a node: which of its rows are in which block, and which pairs are compared here."""

    def __init__(self, table: pa.Table) -> None:
        self.table = table = table.sort_by("number")
        block = table.column("block").to_numpy()
        self.tree, self.low, self.high = (table.column(c)[0].as_py() for c in ("tree", "low", "high"))
        self.mine, self.others = np.flatnonzero(block == self.low), np.flatnonzero(block == self.high)
        self.nodes = np.stack([np.frombuffer(n, np.uint64) for n in table.column("nodes").to_pylist()])

    def parts(self, step: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of the lower block, which of them meets which row of the higher block here first)."""
        others = self.others
        for start in range(0, len(self.mine) if len(others) else 0, step):
            part = self.mine[start : start + step]
            here = np.ones((len(part), len(others)), bool)
            if self.low == self.high:  # every pair once
                here &= part[:, None] < others[None, :]
            for earlier in range(self.tree):  # compared there
                here &= self.nodes[part, earlier][:, None] != self.nodes[others, earlier][None, :]
            yield part, here


_PROPOSED = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("number", "tree", "node")] + [T.StructField(c, T.IntegerType()) for c in ("block", "low", "high")]
)


def _propose(least: int):
    """One pair of blocks of a node -> its documents with a partner whose sketch agrees in ``least`` values."""

    def propose(table: pa.Table) -> pa.Table:
        pair = _Pair(table)
        sketches = np.stack([np.frombuffer(s, np.uint8) for s in pair.table.column("sketch").to_pylist()])
        likely = np.zeros(len(sketches), bool)
        for part, here in pair.parts(64):
            agree = np.zeros(here.shape, np.uint8 if SKETCH < 256 else np.uint16)
            for value in range(SKETCH):
                agree += sketches[part, value][:, None] == sketches[pair.others, value][None, :]
            here &= agree >= least
            likely[part] |= here.any(axis=1)
            likely[pair.others] |= here.any(axis=0)
        return pair.table.select(_PROPOSED.names).filter(pa.array(likely))

    return propose


_LINKS = T.StructType([T.StructField(c, T.LongType()) for c in ("number", "near", "root")])


def shared_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every set on the right."""
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float32)

    def cells(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        flat = np.concatenate(sets)
        at = np.searchsorted(common, flat)
        at[at == len(common)] = 0
        held = common[at] == flat if len(common) else np.zeros(len(flat), bool)
        order = np.argsort(at[held], kind="stable")
        return at[held][order], row[held][order]

    (x, rows), (y, columns) = cells(left), cells(right)
    step = 4096
    for start in range(0, len(common), step):
        a, b = np.searchsorted(x, [start, start + step]), np.searchsorted(y, [start, start + step])
        dense_a, dense_b = (np.zeros((n, step), np.float32) for n in (len(left), len(right)))
        dense_a[rows[a[0] : a[1]], x[a[0] : a[1]] - start] = 1
        dense_b[columns[b[0] : b[1]], y[b[0] : b[1]] - start] = 1
        out += dense_a @ dense_b.T
    return out


def links_between(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs have a Jaccard similarity of at least ``threshold``."""
    a, b = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    shared = shared_shingles(left, right)
    return shared >= threshold * (a[:, None] + b[None, :] - shared) - 1e-6


def _verify(threshold: float):
    """One pair of blocks of a node -> linked documents per shingle set, and a link towards its group."""

    def verify(table: pa.Table) -> pa.Table:
        pair = _Pair(table)
        number, copies = pair.table.column("number").to_numpy(), pair.table.column("copies").to_numpy()
        sets = [np.unique(shingle_sequence(np.frombuffer(w, np.uint64))) for w in pair.table.column("hashes").to_pylist()]
        near, root = np.zeros(len(number), np.int64), np.arange(len(number))
        others = pair.others
        for part, here in pair.parts():
            linked = here & links_between([sets[i] for i in part], [sets[i] for i in others], threshold)
            near[part] += linked @ copies[others]
            near[others] += copies[part] @ linked
            for i, row in zip(part, linked):
                beside = others[row]
                if len(beside):
                    _join(root, np.append(beside, i))
        kept = np.flatnonzero(near)
        roots = number[[_root(root, i) for i in kept]] if len(kept) else number[:0]
        return pa.table({"number": number[kept], "near": near[kept], "root": roots})

    return verify


def _root(root: np.ndarray, i: int) -> int:
    while root[i] != i:
        root[i] = root[root[i]]
        i = root[i]
    return i


def _join(root: np.ndarray, nodes: np.ndarray) -> None:
    """Put the nodes into one tree, under the least of their roots."""
    roots = {_root(root, i) for i in nodes}
    root[list(roots)] = min(roots)


_HASHED = T.StructType([T.StructField("same", T.BinaryType()), T.StructField("hashes", T.BinaryType())])


def _hash(maybe: PossibleMembers | None):
    """(key, text) -> digest of the shingle set and word hashes, of texts whose key may be wanted."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if maybe:
                batch = batch.filter(pa.array(maybe.holds(batch.column(0).to_numpy())))
            for _, texts in rows_of(batch, 1):
                words = [w for w in map(word_hashes, texts) if len(w)]
                same = pa.array([_digest(np.unique(shingle_sequence(w))) for w in words], pa.binary())
                yield pa.RecordBatch.from_arrays([same, pa.array([w.tobytes() for w in words], pa.binary())], names=_HASHED.names)

    return hashed


def similar_documents(docs: DataFrame, threshold: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``class_id`` and ``links`` (long).

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is at
    least ``threshold``; a text of fewer than five words has one shingle. ``links`` counts
    the other documents a document is linked to, copies included, and ``class_id`` is the least id among
    all that links lead to, itself included. Texts without words (NULL, empty,
    punctuation) are similar to nothing and form classes of their own, and so does a row
    without an id, whose class is NULL. Rows that repeat an id are documents of their own. An empty table
    gives no rows; ids are whole numbers; other columns are not read.
    """
    members, classes = _classified(docs, threshold, id_column, text_column)
    return (
        members.select("id", "same")
        .join(classes, "same", "left")
        .select(
            F.col("id").alias(id_column),
            F.when(F.col("id").isNotNull(), F.coalesce("class.id", "id")).alias("class_id"),
            F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("near", F.lit(0))).cast("long").alias("links"),
        )
    )


def _document_key(id_column: str, text_hash: str) -> Column:
    return F.xxhash64(F.col(id_column).cast("long"), text_hash)


def _picked(df: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ``df`` whose key may be among ``keys``, and the others; (all, None) if there are too many keys."""
    maybe = possible_members(keys)
    return (df.where(maybe(key)), df.where(~maybe(key))) if maybe else (df, None)


def _classified(docs: DataFrame, threshold: float, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """The signed rows of ``docs`` (``id``, ``text_hash``, ``same``), and of shingle sets with links ``same``,
    ``class`` (the least id of the class and that row's text hash) and ``near``. Both are stored.

    Joins that could be broadcast on small tables only are merge joins everywhere: they read narrow rows.
    """
    trees, depth = forest_shape(threshold)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text_column).alias("text_hash"), F.col(text_column).alias("text"))
    members = cut_lineage(texts.mapInArrow(_sign(trees, depth), _SIGNED), "signed")
    first = F.min(F.struct("id", "text_hash", "words", "nodes", "sketch"))
    signed = cut_lineage(
        members.where(F.col("same").isNotNull() & F.col("id").isNotNull())
        .groupBy("same")
        .agg(first.alias("f"), F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("number"), "same", "f.*", "copies"),
        "distinct",
    )

    rooted = signed.select("number", "words", "nodes").mapInArrow(_rooted, _ROOTED)
    shared = rooted.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("node")
    forest = cut_lineage(rooted.join(shared.hint("merge"), "node", "left_semi"), "forest")
    likely = cut_lineage(signed.join(forest.select("number").distinct().hint("merge"), "number", "left_semi"), "likely")
    block_pair = ("node", "low", "high")
    candidates = _blocks(forest).join(likely.select("number", "nodes", "sketch").hint("merge"), "number")
    proposed = cut_lineage(candidates.groupBy(*block_pair).applyInArrow(_propose(least_agreement(threshold)), _PROPOSED), "proposed")

    compared = likely.join(proposed.select("number").distinct().hint("merge"), "number", "left_semi")
    wanted = cut_lineage(compared.select("number", "same", "nodes", "copies", _document_key("id", "text_hash").alias("key")), "wanted")
    # The filter is asked by the task that hashes, so that no task needs two Python workers.
    maybe = possible_members(wanted.select("key"))
    again = texts.select(_document_key("id", "text_hash").alias("key"), "text")
    again = again if maybe else again.join(wanted.select("key").distinct(), "key", "left_semi")
    hashed = again.mapInArrow(_hash(maybe), _HASHED).join(wanted.select("same").hint("merge"), "same", "left_semi").dropDuplicates(["same"])
    read = wanted.join(hashed, "same").select("number", "nodes", "copies", "hashes")
    links = cut_lineage(proposed.join(read.hint("merge"), "number").groupBy(*block_pair).applyInArrow(_verify(threshold), _LINKS), "links")

    roots = cut_lineage(components(links.select(F.col("number").alias("a"), F.col("root").alias("b"))), "roots")
    near = links.groupBy("number").agg(F.sum("near").alias("near"))
    linked = near.join(roots.withColumnRenamed("node", "number"), "number", "left")
    grouped = (
        signed.select("number", "same", "id", "text_hash", "copies")
        .join(linked.hint("merge"), "number", "left")
        .select("same", "id", "text_hash", F.coalesce("root", "number").alias("root"), (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("near"))
        .where("near > 0")
    )
    grouped = cut_lineage(grouped, "grouped")
    least = grouped.groupBy("root").agg(F.min(F.struct("id", "text_hash")).alias("class"))
    classes = grouped.join(least, "root").select("same", "class", "near")
    return members, cut_lineage(classes, "classes")


def one_of_each_class(docs: DataFrame, threshold: float = 0.8, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each class of similar ones: that with the least id.

    A document is an id and a text: rows that repeat an id with another text are judged by their own text,
    and of rows that repeat both only one stays. All rows without an id stay. Texts are shuffled only of rows that a
    bounded filter takes for such as go or are repeated; if those are too many for it, of all rows.
    """
    named = docs.where(F.col(id_column).isNotNull())
    members, classes = _classified(named, threshold, id_column, "text")
    text_hash = fresh_name(docs, "_text_hash")
    document = [id_column, text_hash]
    rows = members.select(F.col("id").alias(id_column), F.col("text_hash").alias(text_hash), "same")
    others = (F.col(id_column) != F.col("class.id")) | (F.col(text_hash) != F.col("class.text_hash"))
    gone = cut_lineage(rows.join(classes.hint("merge"), "same").where(others).select(*document).distinct(), "gone")
    repeated = rows.groupBy(*document).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*document)
    keys = cut_lineage(gone.unionByName(repeated).select(_document_key(id_column, text_hash).alias("key")), "keys")
    hashed = named.withColumn(text_hash, F.xxhash64("text"))
    suspects, sure = _picked(hashed, _document_key(id_column, text_hash), keys)
    stay = suspects.dropDuplicates(document).join(gone.hint("merge"), document, "left_anti")
    for part in (sure, docs.where(F.col(id_column).isNull())):
        stay = stay.select(*docs.columns).unionByName(part.select(*docs.columns)) if part is not None else stay
    return stay
