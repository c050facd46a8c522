"""Mergeable states of the star schema, kept up to date by a stream.

A state holds, per key, values that can be merged: sums, counts, or the greatest struct; or the rows that can be
among the k least. Every batch of
cleaned results is reduced to one delta of each state, in a folder named after the batch, so a batch that
is replayed writes its own delta again and nothing twice. Reading a state merges its base with
the deltas after it; when there are many, they are folded into a new base. Dimensions, marts and
dashboard figures come from the states, so a refresh reads new results and states, never old results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridebase.operators.latest import attributes_of, newest_by
from stridebase.operators.rollup import MEASURES, partial_measures
from stridebase.operators.topk import least_with_ties
from stridebase.plans import gold, marts
from stridebase.plans.silver import SILVER_SCHEMA
from stridebase.plans.star_queries import SummedStar
from stridebase.sources import files

BASE, DELTA, DONE = "base-", "delta-", "_SUCCESS"


@dataclass(frozen=True)
class State:
    """``reduce`` makes a delta of cleaned results, ``fold`` one delta of the rows of several."""

    name: str
    reduce: Callable[[DataFrame], DataFrame]
    fold: Callable[[DataFrame], DataFrame]


def keyed(name: str, keys: tuple[str, ...], reduce: Callable[[DataFrame], DataFrame], merge: dict[str, Callable[[str], Column]]) -> State:
    """A state of one row per key; ``merge`` names how the values of several rows of one key become one."""
    return State(name, reduce, lambda rows: rows.groupBy(*keys).agg(*[f(column).alias(column) for column, f in merge.items()]))


def _fastest(fct: DataFrame) -> DataFrame:
    """The results that can be among the fastest, ties of the last included: those of the parts hold those of all."""
    return least_with_ties(fct, "performance_seconds", marts.FASTEST_RESULTS)


_ADDED = dict.fromkeys(MEASURES, F.sum)
ATHLETES = keyed(
    "athletes", ("athlete_key",), lambda df: newest_by(df, "athlete_key", "year_of_event", gold.ATHLETE_ATTRIBUTES), {"newest": F.max}
)
EVENTS = keyed("events", ("event_id",), lambda df: newest_by(df, "event_id", "year_of_event", gold.EVENT_ATTRIBUTES), {"newest": F.max})
YEARS = keyed("years", ("year_id",), gold.dim_time, {"year_of_event": F.max})
ATHLETE_YEARS = keyed("athlete_years", ("year_id", "athlete_key"), lambda df: partial_measures(df, "year_id", "athlete_key"), _ADDED)
EVENT_YEARS = keyed("event_years", ("year_id", "event_id"), lambda df: partial_measures(df, "year_id", "event_id"), _ADDED)
FASTEST = State("fastest", lambda df: _fastest(gold.fct_results(df)), _fastest)
STATES = (ATHLETES, EVENTS, YEARS, ATHLETE_YEARS, EVENT_YEARS, FASTEST)


class StateStore:
    """The states under one folder. There is one writer; any number may read.

    ``most_deltas`` bounds how many deltas a reader merges.
    """

    def __init__(self, spark: SparkSession, location: str, most_deltas: int = 8) -> None:
        self.spark, self.location, self.most_deltas = spark, location, most_deltas

    def _folder(self, state: State, kind: str, batch: int) -> str:
        return f"{self.location}/{state.name}/{kind}{batch:012d}"

    def _complete(self, state: State) -> tuple[int, list[int]]:
        """The batch up to which the newest base reaches, or -1, and the batches with a delta after it."""
        place = f"{self.location}/{state.name}"
        done = [name for name in files.subfolders(self.spark, place) if files.exists(self.spark, f"{place}/{name}/{DONE}")]
        base = max((int(name.removeprefix(BASE)) for name in done if name.startswith(BASE)), default=-1)
        deltas = [int(name.removeprefix(DELTA)) for name in done if name.startswith(DELTA)]
        return base, sorted(batch for batch in deltas if batch > base)

    def paths(self, state: State) -> list[str]:
        """What a reader of the state reads now."""
        base, deltas = self._complete(state)
        return ([self._folder(state, BASE, base)] if base >= 0 else []) + [self._folder(state, DELTA, b) for b in deltas]

    def add(self, silver: DataFrame, batch: int) -> None:
        """Take in the cleaned results of a batch. A batch that is there already, or in a base, changes nothing: its
        delta is written once more, or left out."""
        for state in STATES:
            if batch > self._complete(state)[0]:
                state.reduce(silver).write.mode("overwrite").parquet(self._folder(state, DELTA, batch))

    def read(self, state: State) -> DataFrame:
        """The state of all batches. Before the first there are no rows."""
        paths = self.paths(state)
        rows = self.spark.read.parquet(*paths) if paths else state.reduce(self.spark.createDataFrame([], SILVER_SCHEMA))
        return state.fold(rows)

    def compact(self, most_deltas: int | None = None) -> None:
        """Fold a state with more deltas than allowed into a new base.

        The new base counts from when it is complete; the files it replaces stay until the next
        time, for readers that began before.
        """
        for state in STATES:
            base, deltas = self._complete(state)
            if len(deltas) > (self.most_deltas if most_deltas is None else most_deltas):
                self.read(state).write.mode("overwrite").parquet(self._folder(state, BASE, deltas[-1]))
                self._remove_before(state, base)

    def _remove_before(self, state: State, base: int) -> None:
        """Files that were already replaced by the base before the newest."""
        place = f"{self.location}/{state.name}"
        for name in files.subfolders(self.spark, place):
            kind, batch = name[: len(BASE)], int(name.rpartition("-")[2])
            if (kind == BASE and batch < base) or (name.startswith(DELTA) and batch <= base):
                files.delete_folder(self.spark, f"{place}/{name}")

    # What the states tell

    def dim_athlete(self) -> DataFrame:
        return attributes_of(self.read(ATHLETES), "athlete_key", gold.ATHLETE_ATTRIBUTES)

    def dim_event(self) -> DataFrame:
        return attributes_of(self.read(EVENTS), "event_id", gold.EVENT_ATTRIBUTES)

    def dim_time(self) -> DataFrame:
        return self.read(YEARS)

    def mart_top_countries(self) -> DataFrame:
        return marts.country_mart(self.read(ATHLETE_YEARS), self.dim_athlete())

    def mart_fastest_athletes(self) -> DataFrame:
        return marts.mart_fastest_athletes(self.read(FASTEST), self.dim_athlete(), self.dim_event())

    def star(self, fct_results: DataFrame) -> SummedStar:
        """The star whose measures are the states; only questions about single results read ``fct_results``."""
        return SummedStar(
            fct_results, self.dim_athlete(), self.dim_event(), self.dim_time(), self.read(ATHLETE_YEARS), self.read(EVENT_YEARS)
        )


def refresh_states(silver: DataFrame, store: StateStore, checkpoint: str) -> None:
    """Take the new rows of a stream of cleaned results into the states, and stop.

    The checkpoint belongs to the store: it numbers the batches. A run that ended between a delta and its
    commit repeats that batch with the same rows and number.
    """
    query = (
        silver.writeStream.foreachBatch(lambda df, batch: store.add(df, batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    store.compact()
