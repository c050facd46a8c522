"""Quality of documents by their labelled neighbours in a latent-semantic space.

A document's terms are its words, the shapes of its writing (runs of lower-case letters
count as one sign, all other signs stand for themselves or their kind), and words that
repeat the one before. Weighted terms of a bounded sample of labelled documents give a
truncated singular value decomposition, and its right vectors project every document into
the latent space. The sample's vectors are broadcast; blocks of documents are multiplied with all of
them, so the cosines are exact, and the nearest vote for their label with weights that grow with the cosine.
All factors lie on grids of powers of two on which doubles add up exactly, so a text's cosines do not depend on the
block it is in, and equal voters tie; with the last of the nearest, all that tie with it vote.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridebase.llm.tables import fresh_name
from stridebase.llm.words import rows_of, word_hashes

SAMPLE = 6000  # labelled documents at most
WORDS, SHAPES = 4096, 2048  # hashed terms; one more counts repetitions
TERMS = WORDS + SHAPES + 1
LATENT = 48
NEIGHBOURS = 15
SHARPNESS = 12.0  # a vote weighs exp(SHARPNESS * (cosine - 1))
DOUBT = 0.02  # weight of the share of good documents among the votes
ACCEPTED = 0.3  # score from which a document counts as good
TERM_GRID, LATENT_GRID = float(1 << 16), float(1 << 20)
BLOCK = 256  # documents that are multiplied at once
_SHARES = (0.5, 1.0, 1.0)  # of words, shapes and repetitions in a vector


def _kinds() -> np.ndarray:
    """A small number per byte: signs stand for themselves, letters, digits and blanks for their kind."""
    kinds = np.arange(256, dtype=np.uint32)
    kinds[128:] = ord("a")
    for first, last, kind in (("a", "z", "a"), ("A", "Z", "A"), ("0", "9", "0")):
        kinds[ord(first) : ord(last) + 1] = ord(kind)
    return kinds


KINDS = _kinds()


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(terms, values): counts of words and shapes, and the share of repeating words."""
    words = word_hashes(text)
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    kinds = KINDS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    kinds = kinds[np.append(True, (kinds[1:] != kinds[:-1]) | (kinds[1:] != ord("a")))]
    padded = np.concatenate([np.full(3, 10, np.uint32), kinds])
    grams = padded[:-3] * np.uint32(31**3) + padded[1:-2] * np.uint32(31**2) + padded[2:-1] * np.uint32(31) + padded[3:]
    shapes = (grams * np.uint32(2654435761)) >> np.uint32(21)
    counts = np.bincount(np.concatenate([(words % np.uint64(WORDS)).astype(np.int64), WORDS + shapes.astype(np.int64)]), minlength=TERMS)
    terms = np.flatnonzero(counts)
    values = counts[terms].astype(np.float32)
    again = float((words[1:] == words[:-1]).mean()) if len(words) > 1 else 0.0
    return np.append(terms, TERMS - 1), np.append(values, np.float32(again))


def weighted(counts: list[tuple[np.ndarray, np.ndarray]], rarity: np.ndarray) -> np.ndarray:
    """One row of weighted terms per document."""
    out = np.zeros((len(counts), TERMS), np.float32)
    for row, (terms, values) in zip(out, counts):
        if len(terms):
            row[terms[:-1]] = np.log1p(values[:-1])
            row[-1] = values[-1]
    out[:, :-1] *= rarity
    for first, last, share in ((0, WORDS, _SHARES[0]), (WORDS, TERMS - 1, _SHARES[1])):
        part = out[:, first:last]
        part *= share / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    out[:, -1] *= _SHARES[2]
    return out


def _on_grid(values: np.ndarray, grid: float) -> np.ndarray:
    return np.rint(values.astype(np.float64) * grid) / grid


def _latent(rows: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Unit vectors of weighted rows."""
    out = _on_grid(rows, TERM_GRID) @ projection
    return _on_grid(out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9), LATENT_GRID)


@dataclass
class Voters:
    """What the tasks get: term weights, the projection, and the labelled vectors."""

    rarity: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def prior(self) -> float:
        return (float(self.labels.sum()) + 1) / (len(self.labels) + 2)

    def latent(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return _latent(weighted(counts, self.rarity), self.projection)

    def scores(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The weighted share of good labels among the nearest; the share of all for a text without terms."""
        prior, n = self.prior, min(NEIGHBOURS, len(self.labels))
        if not n:
            return np.full(len(counts), prior)
        cosines = self.latent(counts) @ self.vectors.T
        least = np.partition(cosines, -n, axis=1)[:, -n]
        document, voter = np.nonzero(cosines >= least[:, None])
        weights = np.exp(SHARPNESS * (cosines[document, voter] - 1))
        good = np.bincount(document, weights * self.labels[voter], len(counts))
        scores = (good + DOUBT * prior) / (np.bincount(document, weights, len(counts)) + DOUBT)
        return np.where([len(t) > 0 for t, _ in counts], scores, prior)


def fit(counts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Voters:
    """Latent vectors of the labelled documents by a randomised truncated decomposition with a fixed seed."""
    present = np.zeros(TERMS)
    for terms, _ in counts:
        present[terms] += 1
    rarity = np.log((1 + len(counts)) / (1 + present[:-1])).astype(np.float32) + np.float32(0.1)
    rows = weighted(counts, rarity)
    if not len(counts):
        return Voters(rarity, np.zeros((TERMS, 1)), np.zeros((0, 1)), labels.astype(float))
    width = min(LATENT + 16, len(counts))
    basis = np.random.default_rng(5).standard_normal((len(counts), width)).astype(np.float32)
    for _ in range(4):
        basis = np.linalg.qr(rows @ (rows.T @ basis))[0]
    projection = np.linalg.svd(basis.T @ rows, full_matrices=False)[2][:LATENT].T
    projection = np.ascontiguousarray(_on_grid(projection, TERM_GRID))
    # In blocks, as the sample's rows as doubles would be the largest thing on the driver.
    vectors = np.concatenate([_latent(rows[i : i + BLOCK], projection) for i in range(0, len(rows), BLOCK)])
    return Voters(rarity, projection, vectors, labels.astype(float))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, texts in rows_of(batch, 1):
            counts = [term_counts(t) for t in texts]
            columns = [
                batch.column(0).slice(start, len(texts)),
                pa.array([t.astype(np.uint16).tobytes() for t, _ in counts], pa.binary()),
                pa.array([v.astype(np.float32).tobytes() for _, v in counts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "terms", "counts"])


def held_out(id_column: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row's label may not be learnt from: a fixed fifth of the ids; false for a NULL id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit_voters(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text") -> Voters:
    """Learn from at most ``sample`` labelled documents: those whose ids hash lowest among all
    that are labelled and not held out. Rows with a NULL id or label teach nothing."""
    known = labels.select(id_column, F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col(id_column).isNotNull())
    chosen = known.where(~held_out(id_column)).orderBy(F.xxhash64(id_column), id_column, "label").limit(sample)
    texts = docs.select(id_column, text_column).join(F.broadcast(chosen), id_column).select("label", F.col(text_column).alias("text"))
    # Rows that repeat an id could be more than the bound.
    rows = texts.mapInArrow(_count_terms, "label int, terms binary, counts binary").limit(sample).collect()
    rows.sort(key=lambda r: (bytes(r[1]), bytes(r[2]), r[0]))  # the same model in any order of arrival
    counts = [(np.frombuffer(r[1], np.uint16).astype(np.int64), np.frombuffer(r[2], np.float32)) for r in rows]
    return fit(counts, np.array([r[0] for r in rows], dtype=float))


def quality_scores(docs: DataFrame, voters: Voters, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score``: 0 to 1, higher for texts like those labelled 1.

    Every whole text is scored, with the same score for equal texts; a NULL or empty text gets the
    share of label 1 among the voters (one half if there are none). The columns in ``keep`` are
    kept, by default all; one named ``score`` is replaced.
    """
    kept = docs.drop("score").select(*(keep or docs.drop("score").columns))
    names, last = kept.columns, len(kept.columns)
    rows = docs.select(*names, F.col(text_column).alias(fresh_name(kept, "_text")))
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = shared.value
        for batch in batches:
            for start, texts in rows_of(batch, last, 2 << 20):
                for first in range(0, len(texts), BLOCK):
                    block = texts[first : first + BLOCK]
                    scores = voters.scores([term_counts(t) for t in block])
                    part = batch.slice(start + first, len(block))
                    yield pa.RecordBatch.from_arrays([*part.columns[:last], pa.array(scores)], names=[*names, "score"])

    return rows.mapInArrow(score, T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())]))
