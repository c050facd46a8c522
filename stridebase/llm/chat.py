"""Chat transcripts: a hidden Markov model recovers who speaks, then turns are rendered canonically.

Hidden states are the roles, each as first line of a turn or as a later one. A line shows its
speaker marker and a few features of its form. Probabilities are counted on labelled
lines; Viterbi finds the best sequence of states. Scores are whole numbers, so sums
do not depend on the order of adding.

A transcript may be longer than what one task should hold. Lines are range-partitioned in
order; a transcript that crosses a border is solved from the best scores
between every pair of states over each of its pieces (a small matrix per piece), which
gives the states at the borders; each piece is then decoded alone between them. A turn that
crosses borders is put together again by its number, which runs over all pieces.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridebase.llm.tables import cut_lineage, partitions

ROLES = ("system", "user", "assistant")
STATES = tuple(f"{role}/{part}" for role in ROLES for part in ("first", "later"))
UNIT = 1_000_000  # scores are logarithms in millionths

# Words that name a speaker.
SPEAKERS = """user human customer client person question q me student prompter
assistant ai bot gpt model answer a response agent chatbot teacher
system instruction instructions context setup""".split()
_NAME = "|".join(sorted(SPEAKERS, key=len, reverse=True))
_MARKER = re.compile(
    rf"^\s*(?:<\|im_start\|>\s*(?P<a>{_NAME})\b\s*|<\|(?P<b>{_NAME})\|>\s*|\[(?P<c>{_NAME})\]:?\s*"
    rf"|(?:#+\s*|\*\*|__|>\s*|-\s+)?(?P<d>{_NAME})(?:\*\*|__)?\s*:(?:\*\*|__)?\s*)",
    re.IGNORECASE,
)
_ENDS = re.compile(r"<\|(?:im_end|end|eot_id)\|>\s*$")


def split_marker(line: str) -> tuple[str, str]:
    """(speaker word or empty, rest of the line)."""
    found = _MARKER.match(line)
    if not found:
        return "", line
    return next(g for g in found.groups() if g).lower(), line[found.end() :]


def features(marker: str, content: str, after_blank: bool, at_start: bool) -> tuple[tuple[str, str], ...]:
    """What the model sees of a line."""
    text = content.strip()
    size = "none" if not text else "short" if len(text) < 40 else "middle" if len(text) < 160 else "long"
    return (
        ("marker", marker),
        ("place", "start" if at_start else "after blank" if after_blank else "inside"),
        ("end", "?" if text.endswith("?") else "!" if text.endswith("!") else "other"),
        ("form", "list" if re.match(r"(?:[-*•]|\d+[.)])\s", text) else "code" if text.startswith(("```", "    ")) else "prose"),
        ("size", size),
    )


@dataclass
class Model:
    """Scores: of a state at the start, of a step between states, and of a feature in a state."""

    start: np.ndarray
    step: np.ndarray
    shown: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)
    unseen: dict[str, np.ndarray] = field(default_factory=dict)

    def emission(self, line: tuple[tuple[str, str], ...]) -> np.ndarray:
        return sum(self.shown.get(f, self.unseen[f[0]]) for f in line)


FEATURES = ("marker", "place", "end", "form", "size")


def fit_model(starts: Counter, steps: Counter, shown: Counter) -> Model:
    """From counts of states at the start, of (state, next state), and of (state, feature, value); one is added to each."""

    def score(part: float, whole: float) -> int:
        return round(UNIT * log(part / whole))

    n = len(STATES)
    at_start = sum(starts.values())
    start = np.array([score(starts[s] + 1, at_start + n) for s in STATES], np.int64)
    leaving = Counter()
    for (s, _), c in steps.items():
        leaving[s] += c
    step = np.array([[score(steps[s, t] + 1, leaving[s] + n) for t in STATES] for s in STATES], np.int64)
    model, values = Model(start, step), {f: {v for _, g, v in shown if g == f} for f in FEATURES}
    lines = Counter()
    for (s, f, _), c in shown.items():
        lines[s, f] += c
    for f in FEATURES:
        whole = [lines[s, f] + len(values[f]) + 1 for s in STATES]
        model.unseen[f] = np.array([score(1, w) for w in whole], np.int64)
        for v in values[f]:
            model.shown[f, v] = np.array([score(shown[s, f, v] + 1, w) for s, w in zip(STATES, whole)], np.int64)
    return model


def transfer(model: Model, emissions: list[np.ndarray]) -> np.ndarray:
    """Best score from each state before these lines to each state at their end."""
    out = None
    for e in emissions:
        through = model.step + e[None, :]
        out = through if out is None else (out[:, :, None] + through[None, :, :]).max(axis=1)
    return out


def decode(model: Model, emissions: list[np.ndarray], before: int | None, end: int | None) -> list[int]:
    """The best states of these lines after the state ``before`` (None: from the start of a
    transcript) that end in ``end`` (None: in any). Ties go to the state listed first."""
    back, scores = [], None
    for e in emissions:
        if scores is None:
            scores = (model.start if before is None else model.step[before]) + e
            back.append(np.full(len(STATES), -1 if before is None else before))
        else:
            through = scores[:, None] + model.step
            back.append(through.argmax(axis=0))
            scores = through.max(axis=0) + e
    state = int(scores.argmax()) if end is None else end
    states = []
    for pointers in reversed(back):
        states.append(state)
        state = int(pointers[state])
    return states[::-1]


def borders(pieces: list[tuple[int, np.ndarray, np.ndarray]]) -> dict[int, tuple[int | None, int]]:
    """(piece, transfer, first scores) in order -> piece: (state before it, state at its end) on a best path."""
    alphas = [pieces[0][2]]
    for _, matrix, _ in pieces[1:]:
        alphas.append((alphas[-1][:, None] + matrix).max(axis=0))
    end = int(alphas[-1].argmax())
    out: dict[int, tuple[int | None, int]] = {}
    for i in range(len(pieces) - 1, -1, -1):
        before = int((alphas[i - 1] + pieces[i][1][:, end]).argmax()) if i else None
        out[pieces[i][0]] = (before, end)
        end = before if before is not None else end
    return out


# -- lines in order -----------------------------------------------------------


@dataclass
class Line:
    marker: str
    content: str
    seen: tuple[tuple[str, str], ...]


def lines_of(texts: list[str | None], goes_on: bool) -> list[Line]:
    """The lines of consecutive rows of one transcript; ``goes_on``: a piece before this has some.
    The first line of each piece but the first counts as after no blank line."""
    out: list[Line] = []
    blank = False
    for text in texts:
        for raw in (text or "").split("\n"):
            marker, content = split_marker(raw)
            out.append(Line(marker, _ENDS.sub("", content), features(marker, content, blank, not goes_on and not out)))
            blank = not raw.strip()
    return out


def placed_rows(transcripts: DataFrame) -> DataFrame:
    """Rows in order, in pieces of bounded size: ``conv``, ``place``, ``text``, ``number`` and ``piece``."""
    number = F.monotonically_increasing_id()  # keeps equal rows apart
    rows = transcripts.select("conv", "place", "text").withColumn("number", number)
    spread = rows.repartitionByRange(partitions(rows.sparkSession), *_order())
    return cut_lineage(spread.withColumn("piece", F.spark_partition_id()), "transcripts")


def _order() -> list[Column]:
    return [F.asc_nulls_first("conv"), F.asc_nulls_first("place"), F.asc_nulls_first("text"), F.asc("number")]


def _segments(table: pa.Table) -> Iterator[tuple[int | None, list[str | None]]]:
    """(conversation, texts) of one piece, in order."""
    rows = zip(*(table.column(c).to_pylist() for c in ("conv", "place", "text", "number")))
    smallest = -(1 << 63) - 1
    ordered = sorted(rows, key=lambda r: (smallest if r[0] is None else r[0], smallest if r[1] is None else r[1], r[2] is not None, r[2] or "", r[3]))
    for conv, part in groupby(ordered, key=lambda r: r[0]):
        yield conv, [r[2] for r in part]


def parse_transcripts(transcripts: DataFrame, model: Model) -> DataFrame:
    """One row per recovered turn: ``conv``, ``turn`` (from 0), ``role``, ``content``, ``rendered`` and ``lines``.

    ``transcripts`` has ``conv`` and ``place`` (whole numbers) and ``text``; rows of one ``conv`` in order of
    ``place`` are one transcript, and each row begins a new line. Rows without ``conv`` are one transcript,
    rows without ``place`` come first, equal places go by text, repeated rows are repeated lines. A
    NULL or empty text is one blank line. A transcript begins with a turn whatever its first
    line; an empty table gives no rows; other columns are not read.
    """
    placed = placed_rows(transcripts)
    ends = placed.groupBy("conv").agg(F.min("piece").alias("first"), F.max("piece").alias("last")).where("first < last")
    # A transcript that crosses borders is the last of one piece: fewer of them than partitions.
    crossing = {r["conv"]: (r["first"], r["last"]) for r in ends.collect()}

    def matrices(table: pa.Table) -> pa.Table:
        piece, rows = table.column("piece")[0].as_py(), []
        for conv, texts in _segments(table):
            if conv in crossing:
                goes_on = piece != crossing[conv][0]
                emissions = [model.emission(x.seen) for x in lines_of(texts, goes_on)]
                first = model.start + emissions[0]
                alphas = first if len(emissions) == 1 else (first[:, None] + transfer(model, emissions[1:])).max(axis=0)
                rows.append((conv, piece, transfer(model, emissions).tobytes(), alphas.tobytes()))
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("conv", "piece", "matrix", "alphas"), columns, kinds)})

    at_border: dict[tuple, tuple[int | None, int | None]] = {}
    if crossing:
        solved = placed.groupBy("piece").applyInArrow(matrices, "conv long, piece int, matrix binary, alphas binary")
        n = len(STATES)
        own: dict[int | None, list] = {}
        for r in sorted(solved.collect(), key=lambda r: r["piece"]):
            matrix, alphas = np.frombuffer(r["matrix"], np.int64), np.frombuffer(r["alphas"], np.int64)
            own.setdefault(r["conv"], []).append((r["piece"], matrix.reshape(n, n), alphas))
        for conv, pieces in own.items():
            at_border |= {(conv, piece): states for piece, states in borders(pieces).items()}

    def decoded(table: pa.Table) -> pa.Table:
        piece, rows = table.column("piece")[0].as_py(), []
        for conv, texts in _segments(table):
            goes_on = conv in crossing and piece != crossing[conv][0]
            lines = lines_of(texts, goes_on)
            before, end = at_border.get((conv, piece), (None, None))
            states = decode(model, [model.emission(x.seen) for x in lines], before, end)
            part: list[list] = []
            for i, (line, state) in enumerate(zip(lines, states)):
                role, begins = divmod(state, 2)
                last = states[i - 1] // 2 if i else before // 2 if before is not None else None
                if begins == 0 or last != role:
                    part.append([True, ROLES[role], []])
                elif not part:
                    part.append([False, ROLES[role], []])
                part[-1][2].append(line.content)
            number = -1  # the end of a turn that began before this piece
            for begins, role, content in part:
                number += begins
                rows.append((conv, piece, number, role, "\n".join(content), len(content)))
        columns = list(zip(*rows)) or [[]] * 6
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64())
        names = ("conv", "piece", "number", "role", "content", "lines")
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    schema = "conv long, piece int, number int, role string, content string, lines long"
    parts = cut_lineage(placed.groupBy("piece").applyInArrow(decoded, schema), "parts")
    begun: dict[tuple, int] = {}
    if crossing:
        inside = parts.join(F.broadcast(ends), parts["conv"].eqNullSafe(ends["conv"]), "left_semi")
        begun = {(r[0], r[1]): r[2] + 1 for r in inside.groupBy("conv", "piece").agg(F.max("number")).collect()}
    offsets = []
    for conv, (first, last) in crossing.items():
        turns = 0
        for piece in range(first, last + 1):
            offsets.append((conv, piece, turns))
            turns += begun.get((conv, piece), 0)
    ahead = transcripts.sparkSession.createDataFrame(offsets, "of long, at int, ahead long")
    numbered = parts.join(F.broadcast(ahead), F.col("conv").eqNullSafe(F.col("of")) & (F.col("piece") == F.col("at")), "left")
    pieces = F.sort_array(F.collect_list(F.struct("piece", "content")))
    # An expression that looks for blanks at the end would try every blank inside.
    content = F.btrim(F.array_join(F.transform(pieces, lambda p: p["content"]), "\n"), F.lit(" \t\n\x0b\f\r"))
    turns = (
        numbered.withColumn("turn", F.coalesce("ahead", F.lit(0)) + F.col("number"))
        .groupBy("conv", "turn")
        .agg(F.first("role").alias("role"), content.alias("content"), F.sum("lines").alias("lines"))
    )
    rendered = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "content", F.lit("<|im_end|>"))
    return turns.select("conv", "turn", "role", "content", rendered.alias("rendered"), "lines")


# -- labelled transcripts -----------------------------------------------------


def count_labelled(turns: DataFrame) -> Model:
    """The model of labelled turns: ``conv``, ``place``, ``role`` and the raw ``text`` of one turn per row.

    Lines are counted where they lie; per partition only the counts leave the task. Turns of other
    or NULL roles teach nothing.
    """
    known = turns.where(F.col("role").isin(*ROLES)).select("conv", "place", "role", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("role", "next_role", "text", "blank"))
            for role, follower, text, blank in zip(*columns):
                lines = lines_of([text], goes_on=blank is not None)
                if blank:
                    lines[0].seen = features(lines[0].marker, lines[0].content, True, False)
                states = [f"{role}/first"] + [f"{role}/later"] * (len(lines) - 1)
                if blank is None:
                    counts["start", states[0], ""] += 1
                for line, state, after in zip(lines, states, [*states[1:], follower and f"{follower}/first"]):
                    if after:
                        counts["step", state, after] += 1
                    for name, value in line.seen:
                        counts[name, state, value] += 1
        rows = [(*key, n) for key, n in counts.items()]
        columns = list(zip(*rows)) or [[]] * 4
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["what", "state", "value", "n"])

    # The turn before and after are looked up by place, not by a window over a whole conversation.
    shift = known.select("conv", (F.col("place") - 1).alias("place"), F.col("role").alias("next_role")).dropDuplicates(["conv", "place"])
    ended = F.coalesce(F.col("text").endswith("\n"), F.lit(True))  # a row that is one blank line ends in one
    before = known.select("conv", (F.col("place") + 1).alias("place"), ended.alias("blank")).dropDuplicates(["conv", "place"])
    rows = known.join(shift, ["conv", "place"], "left").join(before, ["conv", "place"], "left")
    counted = rows.select("role", "next_role", "text", "blank").mapInArrow(count, "what string, state string, value string, n long")
    starts, steps, shown = Counter(), Counter(), Counter()
    # Bounded by the states and the feature values.
    for what, state, value, n in counted.groupBy("what", "state", "value").agg(F.sum("n")).collect():
        if what == "start":
            starts[state] += n
        elif what == "step":
            steps[state, value] += n
        else:
            shown[state, what, value] += n
    return fit_model(starts, steps, shown)


def as_transcripts(conversations: DataFrame) -> DataFrame:
    """``conv``, ``place``, ``role`` and ``text``: turns as a person would paste them, from rows of conv_id,
    turn, role and text. The id decides how speakers are marked; one turn in eight, but
    never the first, has lost its marker, and turns are parted by a blank line. The role is the truth to compare with."""
    style = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    lost = (F.crc32(F.concat_ws("/", "conv_id", "turn").cast("binary")) % 8 == 0) & (F.col("turn") > 0)
    names = {"user": ("User", "### Human", "Q", "user"), "assistant": ("Assistant", "### Response", "A", "assistant"), "system": ("System", "### Instruction", "Context", "system")}

    def marker(number: int) -> Column:
        out = F.lit("")
        for role, forms in names.items():
            form = f"[{forms[number]}] " if number == 3 else f"{forms[number]}:\n" if number == 1 else f"{forms[number]}: "
            out = F.when(F.col("role") == role, form).otherwise(out)
        return out

    mark = F.lit("")
    for number in range(4):
        mark = F.when(style == number, marker(number)).otherwise(mark)
    text = F.concat(F.when(F.coalesce(lost, F.lit(False)), "").otherwise(mark), F.coalesce("text", F.lit("")), F.lit("\n"))
    return conversations.select(F.col("conv_id").alias("conv"), F.col("turn").alias("place"), "role", text.alias("text"))
