"""Header clean-up and schema checks; a file with any failure is set aside whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.joins import drop_matching, keep_matching


@dataclass(frozen=True)
class Rule:
    """What a column must hold: text, or text of a whole number (``kind="bigint"``)."""

    column: str
    kind: str = "string"
    nullable: bool = False


def standard_names(names: Sequence[str], renames: Mapping[str, str]) -> list[str]:
    """Header names without blanks around them, mapped where the map has them."""
    trimmed = [name.strip() for name in names]
    return [renames.get(name, name) for name in trimmed]


def standardise_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return df.toDF(*standard_names(df.columns, renames))


def missing_columns(files: DataFrame, file_columns: Sequence[str], absent: str = "absent") -> DataFrame:
    """One failure per file and required column it lacks; ``files`` has one row per file, with those columns listed."""
    lacking = files.select(*file_columns, F.explode(absent).alias("column_name"))
    return lacking.select(*file_columns, F.lit(None).cast("bigint").alias("row_id"), "column_name",
                          F.lit("column_in_dataframe").alias("check_name"), F.col("column_name").alias("failure_case"))


def _violations(rule: Rule, absent: Column | None) -> list[Column]:
    """Null unless the rule is broken, one expression per check."""
    cell = F.col(rule.column)
    checks = []
    if not rule.nullable:
        empty = cell.isNull()
        if absent is not None:
            empty = empty & ~F.coalesce(F.array_contains(absent, rule.column), F.lit(False))
        checks.append((empty, "not_nullable"))
    if rule.kind != "string":
        checks.append((cell.isNotNull() & cell.cast("string").try_cast(rule.kind).isNull(), f"dtype({rule.kind})"))
    return [failure(broken, F.lit(rule.column), name, cell.cast("string")) for broken, name in checks]


def failure(broken: Column, column_name: Column, check_name: str, failure_case: Column) -> Column:
    """A failure structure where the check is broken, else null."""
    return F.when(broken, F.struct(column_name.cast("string").alias("column_name"), F.lit(check_name).alias("check_name"),
                                   failure_case.alias("failure_case")))


def value_failures(rows: DataFrame, rules: Sequence[Rule], file_columns: Sequence[str], row_id: str,
                   absent: Column | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """All failures of all rows, found in one pass without a shuffle.

    Columns the rows lack, or list in ``absent``, are left to :func:`missing_columns`. ``extra`` holds further checks,
    each null or a failure structure.
    """
    present = {name.lower() for name in rows.columns}
    never = failure(F.lit(False), F.lit(None), "", F.lit(None).cast("string"))  # gives an empty list its type
    checks = [check for rule in rules if rule.column.lower() in present for check in _violations(rule, absent)]
    checks = [never, *checks, *extra]
    broken = rows.filter(F.coalesce(*checks).isNotNull())  # lists are built for these only
    return (broken.select(*file_columns, F.col(row_id).cast("bigint").alias("row_id"),
                          F.explode(F.array_compact(F.array(*checks))).alias("f"))
            .select(*file_columns, "row_id", "f.*"))


def schema_failures(rows: DataFrame, rules: Sequence[Rule], file_columns: Sequence[str], row_id: str) -> DataFrame:
    """Failures of rows that share one header: columns they lack, per file, and bad values, per row."""
    present = {name.lower() for name in rows.columns}
    lacking = [F.lit(rule.column) for rule in rules if rule.column.lower() not in present]
    failures = value_failures(rows, [rule for rule in rules if rule.column.lower() in present], file_columns, row_id)
    if lacking:
        files = rows.select(*file_columns).distinct().withColumn("absent", F.array(*lacking))
        failures = failures.unionByName(missing_columns(files, file_columns))
    return failures


def failure_counts(failures: DataFrame, file_columns: Sequence[str]) -> DataFrame:
    return failures.groupBy(*file_columns).agg(F.count(F.lit(1)).alias("failures"))


def accepted_rows(rows: DataFrame, failures: DataFrame, file_columns: Sequence[str], **bounds) -> DataFrame:
    """Rows of the files without any failure."""
    return drop_matching(rows, failures, file_columns, **bounds)


def quarantined_rows(rows: DataFrame, failures: DataFrame, file_columns: Sequence[str], **bounds) -> DataFrame:
    """Rows of the files with a failure, good rows included."""
    return keep_matching(rows, failures, file_columns, **bounds)
