"""Best-fit decreasing packing of token sequences, planned on counts of lengths.

Best-fit decreasing takes the longest piece first and puts it into the open bin with the
least room that still fits. Pieces of one length are interchangeable, so the plan needs only
how many there are of each length: at most ``capacity`` numbers, whatever the corpus. The
open bins hang on a segment tree over their remaining room, which finds the tightest fitting
room in logarithmic time; equal pieces and equal bins are placed together, with the outcome
of placing them one by one. Pieces then find their place by their rank among the pieces
of their length, which is computed by counts per partition; no task sees all pieces.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridebase.llm.tables import cut_lineage, fresh_name
from stridebase.llm.words import rows_of

# Texts with other characters are left to the tokenizers library: about the common ones all
# libraries agree on what is a letter, a number or a blank.
_UNCOMMON = re.compile("[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\u024f\u2010-\u2027]")
_BLANKS = re.compile(r"\s+")
LONGEST_BLANK = 1 << 18  # characters; tiktoken fails on a run of about a million
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letters that stand for the 256 bytes in a byte-level vocabulary."""
    shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _has_long_blank(text: str) -> bool:
    return len(text) > LONGEST_BLANK and any(m.end() - m.start() > LONGEST_BLANK for m in _BLANKS.finditer(text))


class Encoder:
    """Ids of a byte-level BPE tokenizer file, as little-endian unsigned 32-bit bytes.

    The ids are those of the tokenizers library. Where the file's merges are in the order of its ids, as
    in a plain byte-level vocabulary, the faster tiktoken gives the same ids from them;
    texts with uncommon characters, special tokens or very long runs of blanks, and other files, take
    the library itself.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        state = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in state["added_tokens"]]
        self.fast = self._fast(state)

    def _fast(self, state: dict) -> tiktoken.Encoding | None:
        model, before = state["model"], state["pre_tokenizer"] or {}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if state["normalizer"] or {k: before.get(k) for k in plain} != plain or model["type"] != "BPE":
            return None
        vocabulary, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [vocabulary.get("".join(m), -1) for m in merges]
        if ids != sorted(set(ids)) or (ids and ids[0] < 256):
            return None
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in self.special}
        return tiktoken.Encoding("file", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.fast is None or _UNCOMMON.search(text) or any(s in text for s in self.special) or _has_long_blank(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text).astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: ``doc_id``, ``piece`` (from 0), ``start`` (ids before it),
    ``length`` and ``ids`` (binary, little-endian unsigned 32-bit).

    A document's ids are those of its text and then ``end``; a NULL text is empty, and so is
    one id long. Only documents longer than ``capacity`` are cut, into pieces of
    ``capacity``, of which the first may be shorter. A NULL id is kept; repeated rows give
    repeated pieces; other columns are not read. ``tokenizer`` is a path that every executor can read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            ids = batch.column(0)
            for first, texts in rows_of(batch, 1, 1 << 20):
                owner, number, start, parts = [], [], [], []
                for i, text in enumerate(texts, first):
                    data = encode(text or "") + last
                    n = len(data) // 4
                    edge = n % capacity if n > capacity else n
                    edges = [0, *range(edge or capacity, n + 1, capacity)]
                    for p, (x, y) in enumerate(zip(edges, edges[1:])):
                        owner.append(i)
                        number.append(p)
                        start.append(x)
                        parts.append(data[4 * x : 4 * y])
                lengths = pa.array([len(p) // 4 for p in parts], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), lengths, pa.array(parts, pa.binary())],
                    names=[id_column, "piece", "start", "length", "ids"],
                )

    kind = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField(id_column, kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return docs.select(id_column, text_column).mapInArrow(cut, schema)


class Rooms:
    """Which amounts of room some open bin has: a segment tree over 0 to ``most``."""

    def __init__(self, most: int) -> None:
        self.leaves = 1
        while self.leaves <= most:
            self.leaves *= 2
        self.used = [False] * (2 * self.leaves)

    def set(self, room: int, used: bool) -> None:
        node = room + self.leaves
        while node:
            self.used[node] = used if node >= self.leaves else self.used[2 * node] or self.used[2 * node + 1]
            node //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest amount of at least ``least`` that some bin has."""
        node = least + self.leaves
        if node >= 2 * self.leaves:
            return None
        if self.used[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.used[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.used[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing for ``{length: number of pieces}``.

    Rows (length, first rank, first bin, offset, pieces per bin): the pieces of a length
    from that rank on, up to the next row's, go to consecutive bins, so many to each,
    from that offset on.
    """
    rooms = Rooms(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}  # room -> runs of bins (first, number)
    bins, plan = 0, []

    def put(room: int, first: int, number: int) -> None:
        if room and number:
            runs = open_bins.setdefault(room, [])
            if runs and runs[-1][0] + runs[-1][1] == first:
                runs[-1] = (runs[-1][0], runs[-1][1] + number)
            else:
                runs.append((first, number))
            rooms.set(room, True)

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit into {capacity}")
        rank, left = 0, counts[length]
        while left:
            room = rooms.tightest(length)
            if room is None:  # as many new bins as it takes
                room = capacity
                first, number = bins, -(-left // (capacity // length))
                bins += number
            else:
                first, number = open_bins[room].pop()
                if not open_bins[room]:
                    rooms.set(room, False)
            each = room // length  # a bin that got one is the tightest until it is too full
            full = min(number, left // each)
            if full:
                plan.append((length, rank, first, capacity - room, each))
                put(room - each * length, first, full)
                rank, left, first, number = rank + full * each, left - full * each, first + full, number - full
            if number and left < each and left:
                plan.append((length, rank, first, capacity - room, left))
                put(room - left * length, first, 1)
                rank, left, first, number = rank + left, 0, first + 1, number - 1
            if number and room < capacity:
                put(room, first, number)
    return plan


def pack(pieces: DataFrame, capacity: int = 1024, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: its sequence, and where it begins there.

    All columns are kept (existing ones of those two names are replaced) and stored once, so
    drop what the result does not need. Lengths must be 1 to ``capacity``; a piece of NULL
    or another length is an error. An empty table gives no rows. Which of equally long
    pieces goes where follows the order of the stored rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    part, row, ahead, rank = (fresh_name(pieces, f"_{n}") for n in ("part", "row", "ahead", "rank"))
    placed = cut_lineage(
        pieces.withColumn(part, F.spark_partition_id()).withColumn(row, F.monotonically_increasing_id()), "pieces"
    )
    counts = placed.groupBy(F.col(length).cast("int").alias(length), part).agg(F.count(F.lit(1)).alias(ahead))
    # At most one row per partition and length, and ``capacity`` rows on the driver.
    earlier = Window.partitionBy(length).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn(ahead, F.coalesce(F.sum(ahead).over(earlier), F.lit(0)))
    histogram = {r[0]: r[1] for r in counts.groupBy(length).agg(F.sum(ahead)).collect()}
    if None in histogram:
        raise ValueError("a piece has no length")
    plan = np.array(plan_bins(histogram, capacity), dtype=np.int64).reshape(-1, 5)
    within = Window.partitionBy(part, length).orderBy(row)
    ranked = (
        placed.withColumn(rank, F.row_number().over(within) - 1)
        .join(starts, [length, part])
        .withColumn(rank, F.col(rank) + F.col(ahead))
        .select(*pieces.columns, rank)
    )
    names = pieces.columns

    # The plan in order of (length, rank), so that one search finds a piece's row.
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    most = max(histogram.values(), default=0) + 1
    keys = plan[:, 0] * most + plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            long = batch.column(batch.schema.get_field_index(length)).to_numpy(zero_copy_only=False).astype(np.int64)
            r = batch.column(len(names)).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, long * most + r, "right") - 1
            later, each = r - plan[at, 1], plan[at, 4]
            sequence, offset = plan[at, 2] + later // each, plan[at, 3] + later % each * long
            columns = [*batch.columns[: len(names)], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, number of ``pieces``, ``length`` and
    ``ids``, from packed pieces that still carry their ``ids``. A sequence holds at most
    ``capacity`` ids, which bounds its group."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.count(F.lit(1)).alias("pieces"),
        F.sum("length").alias("length"),
        F.aggregate(F.transform(parts, lambda p: p["ids"]), F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
    )
