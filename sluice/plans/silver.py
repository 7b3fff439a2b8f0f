"""Silver: typed rows, the latest version per fund, type and date, added when not there yet."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import layouts
from sluice.functions.dates import coerce_date
from sluice.functions.numbers import decimal_comma
from sluice.operators.loads import (FINISHED, LOAD, Claims, append_part, begin_load, create_loaded_table, create_log,
                                    finish_load, finished_rows, merge_loads)
from sluice.operators.tables import current_table
from sluice.operators.versions import (complete_keys, incomplete_keys, latest_version, typed_projection,
                                       unseen_versions)
from sluice.plans.bronze import PERIODS, bronze_log, bronze_rows

Month = tuple[int | None, int | None]
VERSION = "DATA_MODIFICACAO"
TIE_BREAK = ("arquivo", "ID_SUBCLASSE", *layouts.AMOUNT_COLUMNS, "NR_COTST")


REJECT_VERSION = (*layouts.FILE_VERSION, *PERIODS)


@dataclass(frozen=True)
class SilverTables:
    silver: str
    rejects: str

    @property
    def log(self) -> str:
        return f"{self.silver}_loads"


def create_silver(spark: SparkSession, tables: SilverTables, table_format: str = "parquet",
                  location: str | None = None, extra_keys: Sequence[str] = ()) -> None:
    """Silver and its rejects, two tables of the same loads, and the log of these."""
    def place(name: str) -> str | None:
        return location and f"{location}/{name}"

    create_log(spark, tables.log, table_format, place("silver_loads"))
    columns = layouts.SILVER_COLUMNS + "".join(f", {key} STRING" for key in extra_keys)
    create_loaded_table(spark, tables.silver, columns, tables.log, ("DT_COMPTC",), table_format, place("silver"),
                        Claims(tables.silver, (*layouts.SILVER_KEYS, *extra_keys, VERSION)))
    create_loaded_table(spark, tables.rejects, layouts.BRONZE_COLUMNS, tables.log, PERIODS, table_format, place("rejects"),
                        Claims(tables.rejects, REJECT_VERSION))


def with_day(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("day", coerce_date(F.col("DT_COMPTC")))


def silver_candidates(bronze: DataFrame, extra_keys: Sequence[str] = (), scale: int = 2) -> DataFrame:
    """Latest version per fund, type and date text, typed; amounts may have a decimal point or comma.

    Rows that lack a key are left out, before the ranking: what they lack is part of the partition they would rank in.
    """
    keys = (*layouts.SILVER_KEYS, *extra_keys)
    rankable = complete_keys(with_day(bronze), ("CNPJ_FUNDO", "TP_FUNDO", "day")).drop("day")
    newest = latest_version(rankable, keys, "data_modificacao", [c for c in TIE_BREAK if c not in extra_keys])
    return typed_projection(newest, {c: F.col(c) for c in ("TP_FUNDO", "CNPJ_FUNDO", *extra_keys)},
                            {"DT_COMPTC": F.col("DT_COMPTC")}, {c: F.col(c) for c in layouts.AMOUNT_COLUMNS},
                            (VERSION, F.col("data_modificacao")), lambda amount: decimal_comma(amount, scale))


def silver_rejects(bronze: DataFrame) -> DataFrame:
    """Bronze rows that lack a key, or whose date is none."""
    return incomplete_keys(with_day(bronze), ("CNPJ_FUNDO", "TP_FUNDO", "day")).drop("day")


def in_months(months: Iterable[Month]) -> Column:
    """Bronze rows of the given months, on the partition columns; (None, None) stands for rows without a date."""
    by_year: dict[int | None, list[int | None]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)
    wanted = F.lit(False)
    for year, numbers in by_year.items():
        wanted = wanted | (F.col("ano").isNull() if year is None
                           else (F.col("ano") == year) & F.col("mes").isin(sorted(numbers)))
    return wanted


def days_of_months(months: Iterable[Month], day: Column) -> Column:
    """Dates within the given months, as ranges; adjoining months share one."""
    numbers = sorted({year * 12 + month - 1 for year, month in months if year is not None})
    wanted = F.lit(False)
    while numbers:
        first = last = numbers.pop(0)
        while numbers and numbers[0] == last + 1:
            last = numbers.pop(0)
        # Made by Spark, whose years go further than Python's; literals, so partitions are still pruned.
        start, end = (F.make_date(F.lit(n // 12), F.lit(n % 12 + 1), F.lit(1)) for n in (first, last))
        wanted = wanted | ((day >= start) & (day < F.add_months(end, 1)))
    return wanted


def load_silver(spark: SparkSession, bronze_table: str, tables: SilverTables, months: Iterable[Month] | None = None,
                extra_keys: Sequence[str] = (), scale: int = 2) -> None:
    """Add the latest versions that silver lacks, and the rows that can have none to the rejects, in one load.

    ``months`` limits all tables to the months that changed. The month follows from a ranking key, so what is added
    for them is the same as in a load of everything. Rows that lack a key go to the rejects, as often as bronze has them,
    with the first load that meets their file version. Both tables count once the load has finished: one that breaks off
    has added nothing to either, and the next one adds it all. The log tells which loads of bronze it has covered.
    """
    months = None if months is None else list(months)
    load = begin_load(spark, tables.log)
    covers = [row.carga for row in uncovered_loads(spark, bronze_table, tables).collect()
              if months is None or {tuple(month) for month in row.meses} <= set(months)]
    bronze = bronze_rows(spark, bronze_table)
    silver = finished_rows(spark, tables.silver, tables.log)
    seen = finished_rows(spark, tables.rejects, tables.log)
    if months is not None:
        bronze, seen = bronze.filter(in_months(months)), seen.filter(in_months(months))
        silver = silver.filter(days_of_months(months, F.col("DT_COMPTC")))
    candidates = silver_candidates(bronze, extra_keys, scale)
    new = unseen_versions(candidates, silver, (*layouts.SILVER_KEYS, *extra_keys, VERSION))
    append_part(new, tables.silver, load, cluster_by=["DT_COMPTC"])
    seen = seen.select(*REJECT_VERSION).distinct().withColumns(period_key())
    rejects = unseen_versions(silver_rejects(bronze).withColumns(period_key()), seen, [*layouts.FILE_VERSION, *period_key()])
    append_part(rejects.drop(*period_key()), tables.rejects, load)
    finish_load(spark, tables.log, load, months or (), covers)


def uncovered_loads(spark: SparkSession, bronze_table: str, tables: SilverTables) -> DataFrame:
    """``carga``, ``meses`` of the finished loads of bronze that no finished load of silver has covered yet."""
    loads, done = (current_table(spark, log).where(F.col("estado") == FINISHED)
                   for log in (bronze_log(bronze_table), tables.log))
    return loads.select(LOAD, "meses").join(done.select(F.explode("cobre").alias(LOAD)), LOAD, "left_anti")


def merge_silver(spark: SparkSession, tables: SilverTables) -> bool:
    """Rewrite silver and rejects as one load."""
    return merge_loads(spark, (tables.silver, tables.rejects), tables.log,
                       {tables.silver: ["DT_COMPTC"], tables.rejects: PERIODS}) is not None


def period_key() -> dict[str, Column]:
    """The period in columns without nulls; a file's rows of one period are rejected by one load."""
    return {f"{name}_key": F.coalesce(F.col(name), F.lit(0)) for name in ("ano", "mes")}


def silver_current(silver: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """The state of silver: the last version of each key."""
    return latest_version(silver, (*layouts.SILVER_KEYS, *extra_keys), VERSION, layouts.AMOUNT_COLUMNS)
