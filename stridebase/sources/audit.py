"""Tables that are checked while they are written, and published only if they pass.

Rows and missing values are counted by the write itself, with observed metrics, so they cost no pass of their own.
Repeated keys and dangling references are looked for in the version that has been written and is not
yet published, reading the key columns alone. If a rule that must hold is broken, the version is
removed, the table stays as it was, and the keys that broke it are stored for whoever has to mend them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stridebase.sources.tables import cut_lineage, refresh_table


@dataclass(frozen=True)
class Rules:
    """What holds for a table.

    ``key`` must be unique if ``unique``; otherwise repeats are only reported. ``required`` columns hold no
    NULL. ``references`` maps a column to a table of one column that must hold its values.
    """

    key: str | None = None
    unique: bool = True
    required: tuple[str, ...] = ()
    references: Mapping[str, DataFrame] = field(default_factory=dict)


@dataclass(frozen=True)
class Finding:
    table_name: str
    rule: str
    column_name: str
    checked_rows: int
    broken_keys: int
    broken_rows: int
    must_hold: bool

    @property
    def passed(self) -> bool:
        return not (self.must_hold and self.broken_rows)


class AuditFailed(Exception):
    """A version that was not published; ``violations`` has ``rule, column_name, key_value, rows``."""

    def __init__(self, findings: list[Finding], violations: DataFrame) -> None:
        broken = ", ".join(f"{f.rule} {f.column_name}: {f.broken_rows} rows" for f in findings if not f.passed)
        super().__init__(f"{findings[0].table_name} was not published: {broken}")
        self.findings, self.violations = findings, violations


class Audit:
    """One audit of one write."""

    def __init__(self, table_name: str, rules: Rules) -> None:
        self.table_name, self.rules = table_name, rules
        self.findings: list[Finding] = []
        self._written = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        """``df`` with counts that are filled in when it is written."""
        missing = [F.count_if(F.col(c).isNull()).alias(f"missing_{i}") for i, c in enumerate(self.rules.required)]
        return df.observe(self._written, F.count(F.lit(1)).alias("rows"), *missing)

    def inspect(self, version: DataFrame) -> None:
        """Raise :class:`AuditFailed` if the written version breaks a rule that must hold."""
        counted = self._written.get
        violations = cut_lineage(self._violations(version), "violations")
        broken = {
            (r["rule"], r["column_name"]): (r["keys"], r["rows"])
            for r in violations.groupBy("rule", "column_name").agg(F.count(F.lit(1)).alias("keys"), F.sum("rows").alias("rows")).collect()
        }
        rules = self.rules
        checks = [("required", c, True) for c in rules.required]
        checks += [("unique", rules.key, rules.unique)] if rules.key else []
        checks += [("reference", c, True) for c in rules.references]
        for rule, column, must_hold in checks:
            if rule == "required":
                missing = counted[f"missing_{rules.required.index(column)}"]
                keys, rows = int(missing > 0), missing
            else:
                keys, rows = broken.get((rule, column), (0, 0))
            self.findings.append(Finding(self.table_name, rule, column, counted["rows"], keys, rows, must_hold))
        if not all(f.passed for f in self.findings):
            missing = [
                f"SELECT 'required' AS rule, '{f.column_name}' AS column_name, CAST(NULL AS string) AS key_value, {f.broken_rows}L AS rows"
                for f in self.findings
                if f.rule == "required" and f.broken_rows
            ]
            spark = version.sparkSession
            raise AuditFailed(self.findings, reduce(DataFrame.unionByName, map(spark.sql, missing), violations))

    def _violations(self, version: DataFrame) -> DataFrame:
        def counted(column: str) -> DataFrame:
            """One row per value before any join, with a map side: a frequent key costs no more than a rare one."""
            return version.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))

        found = [version.select(F.lit("").alias("rule"), F.lit("").alias("column_name"), F.lit("").alias("key_value"), F.lit(0).cast("long").alias("rows")).limit(0)]
        rules = self.rules

        def listed(rule: str, column: str, keys: DataFrame) -> DataFrame:
            return keys.select(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), F.col(column).cast("string").alias("key_value"), "rows")

        if rules.key:
            found.append(listed("unique", rules.key, counted(rules.key).where("rows > 1")))
        for column, allowed in rules.references.items():
            values = allowed.toDF(column)
            found.append(listed("reference", column, counted(column).join(values, column, "left_anti")))
        return reduce(DataFrame.unionByName, found)


def publish(df: DataFrame, name: str, comment: str, path: str, rules: Rules, partition_by: tuple[str, ...] = ()) -> tuple[DataFrame, list[Finding]]:
    """:func:`refresh_table` with an audit in front of the publication: the table as read back, and what was found.

    Raises :class:`AuditFailed`, and leaves the table that was there, if a rule that must hold is broken.
    """
    audit = Audit(name.rpartition(".")[2], rules)
    return refresh_table(df, name, comment, path, partition_by, audit), audit.findings


def as_table(spark: SparkSession, findings: list[Finding]) -> DataFrame:
    """Findings as rows."""
    rows = [
        F.struct(
            *[F.lit(getattr(f, c)).alias(c) for c in ("table_name", "rule", "column_name")],
            *[F.lit(getattr(f, c)).cast("long").alias(c) for c in ("checked_rows", "broken_keys", "broken_rows")],
            F.lit(f.must_hold).alias("must_hold"),
            F.lit(f.passed).alias("passed"),
        )
        for f in findings
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))
