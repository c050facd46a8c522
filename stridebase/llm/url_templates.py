"""URL filtering by path templates that are learnt per host, and by fixed rules.

The paths of a host form a tree of segments. Going down from the root, segments are
generalised: a number, date, hash or the like stands for its kind; branches with little
support, and branches that differ from similar siblings neither in the share of bad labels nor
in the shapes of what follows, become one wildcard. A path's template is what is left; it
is rejected if the smoothed share of bad pages among its labelled ones is high.

Every step is a grouping of distinct generalised paths with their counts, so a host
with a third of all pages is summed before it is shuffled, and no task holds a host.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridebase.llm.tables import cut_lineage

DEEPEST = 8  # segments that ``segments_of`` keeps unless told otherwise; what follows counts as one
SUPPORT = 20  # pages below which a branch cannot be told from its siblings
QUANTILE = 2.576  # of the normal distribution: 1 in 100 similar branches is taken for different
TRUST = 10.0  # labelled pages that weigh as much as what is known of the host
REJECTED = 0.5
WILDCARD = "*"

# Kind of a variable segment -> its pattern, in order of preference.
KINDS = {
    "{date}": r"^\d{4}-\d{2}-\d{2}$",
    "{number}": r"^\d+$",
    "{uuid}": r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    "{hex}": r"^(?=.*\d)[0-9a-fA-F]{8,}$",
    "{code}": r"^(?=.*\d)[A-Za-z0-9_-]{16,}$",
}
_NUMBERED_FILE = r"^\d+(\.[A-Za-z0-9]{1,8})$"


@dataclass(frozen=True)
class Rule:
    """What to do with a host, its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def best_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; NULL if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    nothing = F.lit(None).cast("string")

    def first(value) -> Column:
        return reduce(lambda rest, r: F.when(r.fits(host, path), value(r)).otherwise(rest), reversed(ordered), nothing)

    return first(lambda r: r.name), first(lambda r: r.verdict)


def kind_of(segment: Column) -> Column:
    """The segment, or the kind of variable it is."""
    out = F.when(segment.rlike(_NUMBERED_FILE), F.concat(F.lit("{number}"), F.regexp_extract(segment, _NUMBERED_FILE, 1))).otherwise(segment)
    return reduce(lambda rest, kind: F.when(segment.rlike(kind[1]), kind[0]).otherwise(rest), reversed(KINDS.items()), out)


def segments_of(path: Column, deepest: int | None = DEEPEST) -> Column:
    """Generalised segments; empty ones do not count, and those below the deepest, if there is one, are one."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    if deepest is None:
        return F.transform(parts, kind_of)
    kinds = F.transform(F.slice(parts, 1, deepest), kind_of)
    return F.when(F.size(parts) > deepest, F.concat(kinds, F.array(F.lit("**")))).otherwise(kinds)


def _shape(segments: Column) -> Column:
    """Segments as ``w``, or as their kind."""
    return F.array_join(F.transform(segments, lambda s: F.when(s.startswith("{") | (s == "**"), s).otherwise("w")), "/")


def _critical(freedom: Column) -> Column:
    """The chi-square value that a similar branch exceeds once in a hundred times (Wilson and Hilferty)."""
    spread = 2 / (9 * freedom)
    return freedom * F.pow(1 - spread + 2.326 * F.sqrt(spread), F.lit(3.0))


def _merged(paths: DataFrame, level: int) -> DataFrame:
    """``host``, ``before``, ``segment`` of the branches at this level that become a wildcard."""
    at = paths.where(F.size("template") > level).select(
        "host",
        F.array_join(F.slice("template", 1, level), "/").alias("before") if level else F.lit("").alias("before"),
        F.col("template")[level].alias("segment"),
        _shape(F.slice("template", F.lit(level + 2), F.size("template"))).alias("rest"),
        "n",
        "labelled",
        "bad",
    )
    node, branch = ["host", "before"], ["host", "before", "segment"]
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    cells = cut_lineage(at.groupBy(*branch, "rest").agg(*sums), "cells")
    branches = cut_lineage(cells.groupBy(*branch).agg(*sums, F.max(F.struct("n", "rest"))["rest"].alias("main")), "branches")

    # Branches are compared with those that mostly go on in the same way. Their median share of
    # bad labels is not moved by a few bad branches; those near it give the share to compare with.
    kin = [*node, "main"]
    common = branches.where(F.col("n") >= SUPPORT)
    share = F.when(F.col("labelled") > 0, F.col("bad") / F.col("labelled"))
    middle = common.groupBy(*kin).agg(F.percentile_approx(share, 0.5, 10_000).alias("middle"), F.sum("labelled").alias("known"))
    least = 1 / (F.col("known") + 2)
    around = common.join(middle, kin).withColumn("share", F.greatest(least, F.least(1 - least, F.coalesce("middle", F.lit(0.5)))))
    near = around.where(_agrees(F.col("share"), 2 * QUANTILE))
    typical = near.groupBy(*kin).agg(((F.sum("bad") + 1) / (F.sum("labelled") + 2)).alias("share"))
    clean = cut_lineage(common.join(typical, kin).where(_agrees(F.col("share"), QUANTILE)), "clean")

    # Distance of a branch's shapes from those of its kin together; shapes that it lacks add what was expected of them.
    of_kin = cells.join(clean.select(*branch, "main", F.col("n").alias("branch_n")), branch)
    together = of_kin.groupBy(*kin, "rest").agg(F.sum("n").alias("shape_n"))
    whole = together.groupBy(*kin).agg(F.sum("shape_n").alias("kin_n"), F.count(F.lit(1)).alias("shapes"))
    expected = F.col("branch_n") * F.col("shape_n") / F.col("kin_n")
    distances = (
        of_kin.join(together, [*kin, "rest"])
        .join(whole, kin)
        .groupBy(*branch, "main", "shapes")
        .agg((F.sum(F.pow(F.col("n") - expected, F.lit(2.0)) / expected) + F.first("branch_n") - F.sum(expected)).alias("distance"))
    )
    freedom = F.greatest(F.col("shapes") - 1, F.lit(1)).cast("double")
    alike = distances.where((F.col("shapes") == 1) | (F.col("distance") <= _critical(freedom))).select(*branch, "main")
    rare = branches.where(F.col("n") < SUPPORT).select(*branch, F.lit("rare").alias("main"))
    chosen = cut_lineage(alike.unionAll(rare), "chosen")
    # one branch alone is no variable
    several = chosen.groupBy(*kin).agg(F.count(F.lit(1)).alias("merged")).where("merged > 1")
    return chosen.join(several, kin, "left_semi").select(*branch).distinct()


def _agrees(share: Column, quantile: float) -> Column:
    """Whether a branch's bad labels are what chance gives at this share."""
    spread = quantile * F.sqrt(share * (1 - share) * F.col("labelled"))
    return F.abs(F.col("bad") - share * F.col("labelled")) <= spread + 0.5


def _siblings_below(paths: DataFrame, level: int) -> bool:
    """Whether some branches of one node at this level or further down differ."""
    deep = paths.where(F.size("template") > level)
    rest = F.xxhash64(F.slice("template", F.lit(level + 1), F.size("template")))
    nodes = deep.groupBy("host", F.slice("template", 1, level).alias("before")).agg(F.min(rest).alias("least"), F.max(rest).alias("most"))
    return bool(nodes.where("least <> most").take(1))


def learn_templates(paths: DataFrame) -> DataFrame:
    """``host``, ``typed``, and ``template`` of distinct ``(host, typed, segments, n, labelled, bad)`` rows.

    The levels end where no branch has siblings further down, so a few very deep paths do not prolong them.
    """
    paths = paths.withColumn("template", F.col("segments")).drop("segments")
    deepest = paths.agg(F.max(F.size("template"))).first()[0] or 0
    for level in range(deepest):
        if level >= DEEPEST and not _siblings_below(paths, level):
            break
        merged = cut_lineage(_merged(paths, level), "merged")
        before = F.array_join(F.slice("template", 1, level), "/") if level else F.lit("")
        keyed = paths.withColumns({"before": before, "segment": F.get("template", F.lit(level))})
        found = keyed.join(merged.withColumn("hit", F.lit(True)), ["host", "before", "segment"], "left")
        wild = F.transform("template", lambda s, i: F.when(i == level, WILDCARD).otherwise(s))
        paths = cut_lineage(found.withColumn("template", F.when(F.col("hit"), wild).otherwise(F.col("template"))).drop("before", "segment", "hit"), "paths")
    return paths


def _bad_shares(paths: DataFrame) -> DataFrame:
    """``host``, ``template``, ``labelled`` and ``bad_share``: smoothed towards the host's share, and that towards all."""
    templates = paths.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    hosts = templates.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("bad").alias("host_bad"))
    known, bad = hosts.agg(F.sum("host_labelled"), F.sum("host_bad")).first()
    overall = ((bad or 0) + 1) / ((known or 0) + 2)
    of_host = (F.col("host_bad") + TRUST * overall) / (F.col("host_labelled") + TRUST)
    return templates.join(hosts, "host").select("host", "template", "labelled", ((F.col("bad") + TRUST * of_host) / (F.col("labelled") + TRUST)).alias("bad_share"))


def judge_urls(
    pages: DataFrame,
    bad: DataFrame,
    rules: Sequence[Rule] = (),
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per page: its id, ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``template`` and ``bad_share``.

    ``bad`` has ``page`` and ``bad`` (0 or 1); of rows that repeat a page the worst counts, and
    rows with a NULL teach nothing. The longest rule that fits decides; else a page is blocked if its
    template's smoothed share of bad pages is at least ``REJECTED``. A URL that is NULL or
    has no ``://`` has an empty host and path and is judged like any other template. Pages with a
    NULL or repeated id are judged row by row; an empty table gives no rows; other columns are not read.
    """
    url = F.col(url_column)
    parsed = pages.select(F.col(id_column).alias("page"), host_of(url).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"))
    parsed = parsed.withColumn("host", F.coalesce("host", F.lit(""))).withColumn("segments", segments_of(F.col("path"), None))
    parsed = cut_lineage(parsed.withColumn("typed", F.array_join("segments", "/")), "urls")
    known = bad.where(F.col("page").isNotNull() & F.col("bad").isNotNull()).groupBy("page").agg(F.max("bad").alias("bad"))
    marked = parsed.select("page", "host", "typed", "segments").join(known, "page", "left")
    paths = marked.groupBy("host", "typed").agg(
        F.first("segments").alias("segments"), F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    learnt = learn_templates(cut_lineage(paths, "paths"))
    judged = learnt.select("host", "typed", "template").join(_bad_shares(learnt), ["host", "template"])
    rule, verdict = best_rule(rules, F.col("host"), F.col("path"))
    by_share = F.when(F.col("bad_share") >= REJECTED, "block").otherwise("allow")
    return parsed.join(cut_lineage(judged, "templates"), ["host", "typed"]).select(
        F.col("page").alias(id_column),
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, by_share).alias("verdict"),
        F.array_join("template", "/").alias("template"),
        "bad_share",
    )
