"""Benchmark items inside documents: MinHash containment over size classes, then exact.

A short item fills a small part of a long document, and MinHash of the whole document
would not see it. So items are put in classes by their number of shingles, and each class
looks at documents through windows of twice its upper size, half a window apart, so that
one window holds a whole item. Per class, the containment threshold becomes a Jaccard
threshold against a window, and from it the number of single-value bands that finds such
a window with probability ``RECALL``. An item spread over several windows agrees with each in
proportion to its share there, so it is found as well. Every (document, item) pair that agrees in
one value is then checked on the complete sets: shared shingles / shingles of the item.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from stridebase.llm.words import SHINGLE, fold, minhash, rows_of, seeds, shingle_sequence, word_hashes

RECALL = 0.9999
SEED = 8
BLOCK_BYTES = 32 << 20  # of item shingles that a task holds at once
WIDEST_CLASS = 1 << 12  # items with more shingles share the class of the largest windows


@dataclass
class SizeClass:
    """Items with up to ``upper`` shingles: which items have which value in which band."""

    upper: int
    multipliers: np.ndarray
    values: list[np.ndarray] = field(default_factory=list)  # per band, ascending
    items: list[np.ndarray] = field(default_factory=list)  # their items, in the same order
    low_bits: list[np.ndarray] = field(default_factory=list)  # per band, whether some value ends so

    def add_band(self, values: np.ndarray, items: np.ndarray) -> None:
        order = np.argsort(values, kind="stable")
        self.values.append(values[order])
        self.items.append(items[order])
        table = np.zeros(1 << min(22, max(16, ceil(log2(64 * len(values))))), bool)
        table[values & np.uint32(len(table) - 1)] = True
        self.low_bits.append(table)

    def candidates(self, folded: np.ndarray, starts: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs that agree in some window and band. ``folded`` holds the
        shingles of all documents in their order, ``starts`` where each begins; none is empty."""
        sizes = np.diff(starts, append=len(folded))
        halves = -(-sizes // self.upper)
        owner = np.repeat(np.arange(len(starts)), halves)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(halves) - halves, halves)
        begins = starts[owner] + nth * self.upper
        last = np.append(owner[1:] != owner[:-1], True)
        hashed, found = np.empty_like(folded), set()
        for a, values, items, table in zip(self.multipliers, self.values, self.items, self.low_bits):
            np.multiply(folded, a, out=hashed)
            half = np.minimum.reduceat(hashed, begins)
            least = half.copy()
            np.minimum(half[:-1], half[1:], out=least[:-1], where=~last[:-1])
            for w in np.flatnonzero(table[least & np.uint32(len(table) - 1)]):
                x, y = np.searchsorted(values, least[w], "left"), np.searchsorted(values, least[w], "right")
                found.update((int(owner[w]), int(i)) for i in items[x:y])
        return found


def bands(least_items: int, upper: int, threshold: float) -> int:
    """Bands that find a window with a contained item with probability ``RECALL``."""
    jaccard = threshold * least_items / (2 * upper + (1 - threshold) * least_items)
    return ceil(log(1 - RECALL) / log(1 - jaccard))


def size_classes(sets: list[np.ndarray], threshold: float) -> list[SizeClass]:
    """Classes by powers of two; ``sets`` are the items' shingles, not empty."""
    by_class: dict[int, list[int]] = {}
    for i, s in enumerate(sets):
        by_class.setdefault(min(ceil(log2(len(s))), int(log2(WIDEST_CLASS))) if len(s) > 1 else 0, []).append(i)
    classes = []
    for power, members in sorted(by_class.items()):
        upper = max(4, 1 << power)
        least = min(len(sets[i]) for i in members)
        made = SizeClass(upper, seeds(bands(min(least, upper), upper, threshold), SEED))
        signatures = np.stack([minhash(sets[i], made.multipliers) for i in members])
        for column in signatures.T:
            made.add_band(column, np.array(members, np.int64))
        classes.append(made)
    return classes


def item_sets(texts: list[str | None]) -> list[np.ndarray]:
    return [np.unique(shingle_sequence(word_hashes(t))) for t in texts]


def item_blocks(items: DataFrame, id_column: str, text_column: str) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(ids, shingle sets) of the items that have words, at most ``BLOCK_BYTES`` at a time."""
    ids: list = []
    sets: list[np.ndarray] = []
    held = 0
    for row in items.select(id_column, text_column).toLocalIterator():
        shingles = item_sets([row[1]])[0]
        if not len(shingles):
            continue
        if ids and held + shingles.nbytes > BLOCK_BYTES:
            yield ids, sets
            ids, sets, held = [], [], 0
        ids.append(row[0])
        sets.append(shingles)
        held += shingles.nbytes
    if ids:
        yield ids, sets


def find_contained(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.8,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and item it contains: the two ids, ``shared`` and ``item_shingles``
    (long), ``containment`` (double), and ``first_word``, ``last_word`` (long): the first and last word of
    the document, counted from 0, that belong to shared shingles.

    An item of fewer than five words is one shingle of all its words, and so only found in a
    document of exactly these words. A document or item without words (NULL, empty,
    blank) matches nothing. NULL ids are kept; repeated rows of either table give repeated
    pairs; other columns are not read; an empty table gives no rows.

    The items' sets are shipped to the tasks in blocks of a fixed size. A benchmark larger
    than a block is searched block by block, each in one pass over the documents.
    """
    schema = T.StructType(
        [
            T.StructField(doc_id, docs.schema[doc_id].dataType),
            T.StructField(item_id if item_id != doc_id else f"item_{item_id}", items.schema[item_id].dataType),
            T.StructField("shared", T.LongType()),
            T.StructField("item_shingles", T.LongType()),
            T.StructField("containment", T.DoubleType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("last_word", T.LongType()),
        ]
    )
    spark = docs.sparkSession
    found = None
    for ids, sets in item_blocks(items, item_id, item_text):
        block = spark.sparkContext.broadcast((ids, sets))
        part = docs.select(doc_id, doc_text).mapInArrow(_search(block, threshold, schema), schema)
        found = part if found is None else found.unionAll(part)
    return spark.createDataFrame([], schema) if found is None else found


_classes: dict[tuple, list[SizeClass]] = {}  # of the last block this worker has seen


def _remembered(block: Broadcast, threshold: float):
    """What gives a task the sets of a block and their size classes."""
    key = (uuid.uuid4().hex, threshold)

    def classes_of() -> tuple[list[np.ndarray], list[SizeClass]]:
        sets = block.value[1]
        classes = _classes.get(key)
        if classes is None:
            _classes.clear()
            classes = _classes[key] = size_classes(sets, threshold)
        return sets, classes

    return classes_of


def _search(block: Broadcast, threshold: float, schema: T.StructType):
    """The search in a batch of documents."""
    kind = to_arrow_type(schema.fields[1].dataType)
    classes_of = _remembered(block, threshold)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, classes = classes_of()
        names = pa.array(block.value[0], kind)
        for batch in batches:
            for start, texts in rows_of(batch, 1, 1 << 20):
                hits = contained(texts, sets, classes, threshold)
                if hits:
                    rows, found, shared, size, first, last = (np.array(x) for x in zip(*hits))
                    columns = [batch.column(0).take(pa.array(rows + start)), names.take(pa.array(found))]
                    columns += map(pa.array, (shared, size, shared / size, first, last))
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return search


def contained(texts: list[str | None], sets: list[np.ndarray], classes: list[SizeClass], threshold: float) -> list[tuple]:
    """(text, item, shared, size, first word, last word) of every item whose shingles a text
    holds at least ``threshold`` of."""
    words = [word_hashes(t) for t in texts]
    sequences = [shingle_sequence(w) for w in words]
    filled = [i for i, s in enumerate(sequences) if len(s)]
    if not filled:
        return []
    folded = fold(np.concatenate([sequences[i] for i in filled]))
    starts = np.cumsum([0, *(len(sequences[i]) for i in filled[:-1])])
    own: dict[int, np.ndarray] = {}
    hits = []
    for at, item in sorted(set().union(*(c.candidates(folded, starts) for c in classes))):
        text, wanted = filled[at], sets[item]
        sequence = sequences[text]
        if text not in own:
            own = {text: np.unique(sequence)}
        shared = int(np.isin(wanted, own[text], assume_unique=True).sum())
        if shared >= threshold * len(wanted) - 1e-9:
            places = np.flatnonzero(np.isin(sequence, wanted))
            hits.append((text, item, shared, len(wanted), int(places[0]), int(places[-1]) + min(SHINGLE, len(words[text])) - 1))
    return hits


def without_contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose own text contains no item, whatever their id and those of other rows.

    They are searched and given up where they are read, without a join; a benchmark larger than a block
    takes one pass per block.
    """
    spark = docs.sparkSession
    clean, at = docs, docs.columns.index("text")
    for ids, sets in item_blocks(items, "item_id", "text"):
        clean = clean.mapInArrow(_keep_clean(spark.sparkContext.broadcast((ids, sets)), threshold, at), docs.schema)
    return clean


def _keep_clean(block: Broadcast, threshold: float, at: int):
    """The rows of a batch whose text, in column ``at``, contains no item of the block."""
    classes_of = _remembered(block, threshold)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, classes = classes_of()
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for start, texts in rows_of(batch, at, 1 << 20):
                clean[[start + hit[0] for hit in contained(texts, sets, classes, threshold)]] = False
            yield batch.filter(pa.array(clean))

    return keep
