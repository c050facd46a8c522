"""Tokens of two tokenizers laid over each other by their bytes.

A text is encoded by a byte-level file (A) and a sentence-piece model (B). Byte offsets at which tokens
of both end cut it into groups, and every A token is linked to every B token of its group. Most
groups are one A token and the B token of the same bytes; which one that is depends on the vocabularies
alone, so it is an array from A ids to B ids, made once. Documents that hold such a pair are
counted in a vector as long as the vocabulary. Only pairs of other groups are counted by a shuffle.

Texts are encoded once. What is kept of a document is each pair it links and how often, in blocks of about
``BLOCK_BYTES`` of text. A block hands over each irregular pair once, with its number of documents; the sums
go back to the blocks that hold the pair, and each block looks its documents' irregular pairs up in them. So
what is shuffled grows with distinct pairs, not with links; the driver holds vectors as long as the
vocabulary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridebase.llm.packing import Encoder, _byte_letters
from stridebase.llm.tables import cut_lineage
from stridebase.llm.words import rows_of

BLOCK_BYTES = 12 << 20  # of text; a longer text is a block of its own
STEP_BYTES = 2 << 20  # of text that are laid over each other at once
PAIRS_AT_ONCE = 1 << 21  # links in memory at once
ROWS_AT_ONCE = 4096  # documents of a block whose links are looked up together
SMALL_GROUP = 64  # links; in larger groups equal ids are put together first


class Vocabularies:
    """Both tokenizers, the bytes and the printed ids of their tokens, and the pairs of equal bytes."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import json

        import sentencepiece

        self.a = Encoder(path_a)
        self.a.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        self.a.special = []
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        vocabulary = json.loads(self.a.tokenizer.to_str())["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.bytes_a[i] = bytes(letters[c] for c in token)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        pairs = len(self.bytes_a) * len(self.bytes_b)
        self.stored_id, self.stored_pair = "<u2" if len(self.bytes_a) <= 1 << 16 else "<u4", "<u4" if pairs <= 1 << 32 else "<u8"
        self.length_a = np.array([len(t) for t in self.bytes_a])
        self.length_b = np.array([len(t) for t in self.bytes_b])
        by_bytes: dict[bytes, int] = {}
        for i, token in enumerate(self.bytes_b):
            if token and not self.b.is_byte(i):
                by_bytes.setdefault(token, i)
        for i, token in enumerate(self.bytes_b):  # a byte piece only where no other piece has its bytes
            by_bytes.setdefault(token, i)
        self.twin = np.array([by_bytes.get(t, -1) if t else -1 for t in self.bytes_a])
        # Printed ids with what follows them: the next of the side, the other side, the next group.
        self.text_a = [np.array([b"%d%s" % (i, e) for i in range(len(self.bytes_a))]) for e in (b",", b"|")]
        self.text_b = [np.array([b"%d%s" % (i, e) for i in range(len(self.bytes_b))]) for e in (b",", b";")]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids by A of space and text, and by B of the text; none where their bytes are not those of the text."""
        none = np.zeros(0, np.int64)
        for text, ids_b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1)):
            ids_a = np.frombuffer(self.a(f" {text}"), "<u4").astype(np.int64) if text else none
            whole = f" {text}".encode("utf-8", "surrogatepass")
            same = text and whole == b"".join([self.bytes_a[i] for i in ids_a]) == b"".join([self.bytes_b[i] for i in ids_b])
            yield (ids_a, np.array(ids_b, np.int64)) if same else (none, none)


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


class Overlay:
    """Groups of consecutive documents, given by their ids of both sides on end.

    ``group_a`` and ``group_b`` number the group of every token; ``document`` is the document of every group.
    """

    def __init__(self, known: Vocabularies, a: list[np.ndarray], b: list[np.ndarray]) -> None:
        self.known, self.documents = known, len(a)
        self.a, self.b = np.concatenate(a), np.concatenate(b)
        # Both sides of a document are equally long, so offsets may run on over documents.
        ends_a, ends_b = np.cumsum(known.length_a[self.a]), np.cumsum(known.length_b[self.b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        self.groups = len(common)
        self.size_a, self.size_b = (np.bincount(g, minlength=self.groups) for g in (self.group_a, self.group_b))
        owner = np.repeat(np.arange(len(a)), [len(x) for x in a])
        self.document = owner[np.cumsum(self.size_a) - 1] if self.groups else owner
        self.links = self._per_document(self.size_a * self.size_b)

    def _per_document(self, values: np.ndarray) -> np.ndarray:
        held = np.append(0, np.cumsum(values))
        return np.diff(held[np.searchsorted(self.document, np.arange(self.documents + 1))])

    def group_counts(self) -> np.ndarray:
        return np.bincount(self.document, minlength=self.documents)

    def digests(self) -> list[str]:
        """SHA-256 of the printed groups of each document; without tokens ''."""
        last_a = np.append(self.group_a[1:] != self.group_a[:-1], True)[: len(self.a)]
        last_b = np.append(self.group_b[1:] != self.group_b[:-1], True)[: len(self.b)]
        # A token's place: after all A tokens before it and the B tokens of the groups before its own.
        before_b = np.append(0, np.cumsum(self.size_b))[self.group_a]
        before_a = np.cumsum(self.size_a)[self.group_b]
        texts_a, texts_b = self.known.text_a, self.known.text_b
        width = max(t.dtype.itemsize for t in (*texts_a, *texts_b))
        out = np.zeros(len(self.a) + len(self.b), f"S{width}")
        out[np.arange(len(self.a)) + before_b] = np.where(last_a, texts_a[1][self.a], texts_a[0][self.a])
        out[np.arange(len(self.b)) + before_a] = np.where(last_b, texts_b[1][self.b], texts_b[0][self.b])
        tokens = self._per_document(self.size_a + self.size_b)
        ends = np.cumsum(tokens)
        parts = [out[e - n : e].tobytes().translate(None, b"\0")[:-1] for n, e in zip(tokens, ends)]
        return [hashlib.sha256(p).hexdigest() if p else "" for p in parts]

    def pairs(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first document, one past the last, and per pair its document, pair, links): every pair a document
        links, once, in runs of whole documents.

        A pair is A id * size of B's vocabulary + B id.
        """
        at = 0
        held = np.append(0, np.cumsum(self.links))
        while at < self.documents:
            end = max(at + 1, int(np.searchsorted(held, held[at] + PAIRS_AT_ONCE, "right")) - 1)
            yield at, end, *self._distinct(at, end)
            at = end

    def _distinct(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs of documents ``first`` to ``last`` - 1. Of a document with very many links, only distinct pairs are held."""
        n = len(self.known.bytes_b)
        start, end = np.searchsorted(self.document, [first, last])
        keys, links = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for group, a, b, weight in self._links(int(start), int(end)):
            key = (self.document[group] - first) * (len(self.known.bytes_a) * n) + a * n + b
            keys, place = np.unique(np.append(keys, key), return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, place, np.append(links, weight))
            links = total
        document, pair = np.divmod(keys, len(self.known.bytes_a) * n)
        return document + first, pair, links

    def _links(self, start: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(group, A id, B id, number) of the links of these groups, in runs of bounded size."""
        first_a, first_b = np.append(0, np.cumsum(self.size_a)), np.append(0, np.cumsum(self.size_b))
        number = self.size_a[start:end] * self.size_b[start:end]
        small = np.flatnonzero(number <= SMALL_GROUP) + start
        held = np.append(0, np.cumsum(number[small - start]))
        at = 0
        while at < len(small):
            stop = int(np.searchsorted(held, held[at] + PAIRS_AT_ONCE, "right")) - 1
            groups = small[at : max(stop, at + 1)]
            at = max(stop, at + 1)
            n = number[groups - start]
            group = np.repeat(groups, n)
            i = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
            row, column = np.divmod(i, self.size_b[group])
            yield group, self.a[first_a[group] + row], self.b[first_b[group] + column], np.ones(len(group), np.int64)
        for g in (np.flatnonzero(number > SMALL_GROUP) + start).tolist():
            a, times_a = np.unique(self.a[first_a[g] : first_a[g + 1]], return_counts=True)
            b, times_b = np.unique(self.b[first_b[g] : first_b[g + 1]], return_counts=True)
            step = max(1, PAIRS_AT_ONCE // len(b))
            for i in range(0, len(a), step):
                x, times = a[i : i + step], times_a[i : i + step]
                size = len(x) * len(b)
                yield np.full(size, g), np.repeat(x, len(b)), np.tile(b, len(x)), np.outer(times, times_b).ravel()


# One row per document, per irregular pair of a block, and per A id with documents that link it to the
# piece of its bytes (no ``block``). Of a document, each pair it links and how often: pairs of equal bytes
# by their A id (``same``), others (``odd``) as pairs.
_DOCUMENT = "doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_LAID = "block long, " + _DOCUMENT + ", same binary, same_links binary, odd binary, odd_links binary, pair long, docs long"
_PARTLY = "block long, " + _DOCUMENT + ", n_best long, count_sum long, odd binary, odd_links binary"
_LOOKED_UP = _DOCUMENT + ", n_best long, count_sum long"


def _narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0, in as many bytes each as the largest needs."""
    most = int(numbers.max()) if len(numbers) else 0
    return numbers.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if most <= np.iinfo(t).max)).tobytes()


def _wide(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // count}" if count else "<u1").astype(np.int64)


def _batch(schema: T.StructType, **columns) -> pa.RecordBatch:
    """A record batch of these columns, the others NULL."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    n = len(next(iter(columns.values())))
    arrays = [
        (c if isinstance(c := columns[f.name], pa.Array) else pa.array(c)).cast(f.type) if f.name in columns else pa.nulls(n, f.type)
        for f in target
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def _lay(path_a: str, path_b: str, schema: T.StructType):
    """Documents -> their groups and pairs, and what each block counts."""

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabularies(path_a, path_b)
        n = len(known.bytes_b)
        block, held = TaskContext.get().partitionId() << 32, 0
        twins = np.zeros(len(known.bytes_a), np.int64)
        counted: list[tuple[np.ndarray, np.ndarray]] = []

        def irregular() -> Iterator[pa.RecordBatch]:
            if counted:
                pairs, docs = _added(counted)
                yield _batch(schema, block=np.full(len(pairs), block), pair=pairs, docs=docs)

        for batch in batches:
            for start, texts in rows_of(batch, 1, STEP_BYTES):
                size = sum(len(t) for t in texts if t)
                if held and held + size > BLOCK_BYTES:
                    yield from irregular()
                    counted, block, held = [], block + 1, 0
                held += size
                a, b = zip(*known.encode(texts))
                laid = Overlay(known, list(a), list(b))
                linked = [[], [], [], []]
                for first, last, document, pair, links in laid.pairs():
                    twin = known.twin[pair // n] == pair % n
                    np.add.at(twins, pair[twin] // n, 1)
                    counted.append(np.unique(pair[~twin], return_counts=True))
                    if sum(len(p) for p, _ in counted) > 4 * PAIRS_AT_ONCE:
                        counted = [_added(counted)]
                    edges = np.searchsorted(document, np.arange(first, last + 1))
                    for x, y in zip(edges, edges[1:]):
                        same, p, m = twin[x:y], pair[x:y], links[x:y]
                        for column, numbers in zip(linked, (p[same] // n, m[same], p[~same], m[~same])):
                            column.append(numbers)
                yield _batch(
                    schema,
                    block=np.full(len(texts), block),
                    doc_id=batch.column(0).slice(start, len(texts)),
                    n_a=[len(x) for x in a],
                    n_b=[len(x) for x in b],
                    n_groups=laid.group_counts(),
                    n_links=laid.links,
                    groups_sha256=laid.digests(),
                    same=pa.array([x.astype(known.stored_id).tobytes() for x in linked[0]], pa.binary()),
                    same_links=pa.array(map(_narrow, linked[1]), pa.binary()),
                    odd=pa.array([x.astype(known.stored_pair).tobytes() for x in linked[2]], pa.binary()),
                    odd_links=pa.array(map(_narrow, linked[3]), pa.binary()),
                )
        yield from irregular()
        ids = np.flatnonzero(twins)
        yield _batch(schema, pair=ids * n + known.twin[ids], docs=twins[ids])

    return lay


def _added(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of pairs, equal pairs added."""
    pairs, place = np.unique(np.concatenate([p for p, _ in counted]), return_inverse=True)
    total = np.zeros(len(pairs), np.int64)
    np.add.at(total, place, np.concatenate([d for _, d in counted]))
    return pairs, total


def align(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best``, ``count_sum``
    (long) and ``groups_sha256``.

    The count of an id pair is the number of documents that hold it linked, over the whole table.
    ``n_best`` are the links whose count is the highest of their A id, ties included; ``count_sum`` adds the
    counts of all links. The digest is that of the groups printed as ``a1,a2|b1;a3|b2,b3``.

    A is given space and text, B the text, to which it adds the space; special tokens' strings in a text are
    plain text. Texts that are NULL, empty, or that a tokenizer does not give back byte for byte
    have no tokens: zeros, and an empty digest. Rows that repeat an id are documents of their own; a NULL id is
    kept. An empty table gives no rows; other columns are not read. ``path_a`` is a byte-level tokenizers
    file, ``path_b`` a sentencepiece model; every executor must be able to read them.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    laid_schema, partly, result = (T.StructType.fromDDL(s.format(id=kind)) for s in (_LAID, _PARTLY, _LOOKED_UP))
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    laid = cut_lineage(texts.mapInArrow(_lay(path_a, path_b, laid_schema), laid_schema), "laid")

    known = vocabularies(path_a, path_b)
    size_a, size_b = len(known.bytes_a), len(known.bytes_b)
    sums = Window.partitionBy("pair")
    pairs = laid.where("pair is not null and block is not null").select("block", "pair", "docs")
    counted = cut_lineage(pairs.select("block", "pair", F.sum("docs").over(sums).alias("docs")), "pairs")
    # Vectors as long as A's vocabulary.
    twins, best = np.zeros(size_a, np.int64), np.zeros(size_a, np.int64)
    regular = laid.where("pair is not null and block is null").groupBy("pair").agg(F.sum("docs").alias("docs")).toArrow()
    ids = regular.column("pair").to_numpy() // size_b
    twins[ids] = best[ids] = regular.column("docs").to_numpy()
    highest = counted.groupBy(F.expr(f"cast(pair div {size_b} as int)").alias("a")).agg(F.max("docs").alias("docs")).toArrow()
    ids = highest.column("a").to_numpy()
    best[ids] = np.maximum(best[ids], highest.column("docs").to_numpy())
    vectors = spark.sparkContext.broadcast((twins, best))

    def regular(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the vectors know; the other pairs go on."""
        known = vocabularies(path_a, path_b)
        twins, best = vectors.value
        for batch in batches:
            ids, count, links, owner = _flat(batch.column("same"), batch.column("same_links"), known.stored_id)
            at_best = np.where(twins[ids] == best[ids], links, 0)
            rows = {f.name: batch.column(f.name) for f in partly if f.name not in ("n_best", "count_sum")}
            yield _batch(partly, **rows, n_best=_total(owner, at_best, len(count)), count_sum=_total(owner, twins[ids] * links, len(count)))

    def look_up(documents: pa.Table, known_pairs: pa.Table) -> pa.Table:
        """The other pairs of a block's documents, by the block's counts."""
        known = vocabularies(path_a, path_b)
        _, best = vectors.value
        keys, counts = (known_pairs.column(c).to_numpy() for c in ("pair", "docs"))
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        columns = {name: documents.column(name) for name in result.names}
        sums, bests = (columns[c].to_numpy().copy() for c in ("count_sum", "n_best"))
        for start in range(0, documents.num_rows, ROWS_AT_ONCE):
            part = documents.slice(start, ROWS_AT_ONCE)
            pair, number, links, owner = _flat(part.column("odd"), part.column("odd_links"), known.stored_pair)
            count = counts[np.searchsorted(keys, pair)]
            rows = slice(start, start + part.num_rows)
            sums[rows] += _total(owner, count * links, len(number))
            bests[rows] += _total(owner, np.where(count == best[pair // size_b], links, 0), len(number))
        return pa.table(columns | {"count_sum": pa.array(sums), "n_best": pa.array(bests)})

    known_part = laid.where("n_a is not null").drop("pair", "docs").mapInArrow(regular, partly)
    looked_up = known_part.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(look_up, result)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return looked_up.select(F.col("doc_id").alias(id_column), *names)


def _flat(values: pa.Array, links: pa.Array, stored: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(value, number of values per row, links, row) of packed columns, on end."""
    packed = values.to_pylist()
    number = np.array([len(v) for v in packed], np.int64) // np.dtype(stored).itemsize
    value = np.frombuffer(b"".join(packed), stored).astype(np.int64)
    times = [_wide(data, n) for data, n in zip(links.to_pylist(), number.tolist())]
    return value, number, np.concatenate([np.zeros(0, np.int64), *times]), np.repeat(np.arange(len(number)), number)


def _total(owner: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    total = np.zeros(rows, np.int64)
    np.add.at(total, owner, values)
    return total
