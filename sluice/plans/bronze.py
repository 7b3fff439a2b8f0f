"""Bronze: new members of landed archives, checked per file and appended once."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import layouts
from sluice.functions.dates import period_columns
from sluice.functions.names import strip_extension
from sluice.operators.joins import settle
from sluice.operators.loads import (Claims, Load, append_part, begin_load, create_loaded_table, create_log, finish_load,
                                    finished_rows, log_state, merge_loads, part_rows)
from sluice.operators.quality import accepted_rows, failure, missing_columns, value_failures
from sluice.operators.versions import unseen_versions
from sluice.session import folder_exists, new_folder, remove_folder
from sluice.sources.archives import MAX_TASKS, TASK_BYTES, data_rows, listed_archives, member_rows, unreadable_members
from sluice.sources.landing import landing_manifest
from sluice.sources.large_members import all_rows

log = logging.getLogger(__name__)

# One member of one archive in one version.
FILE = ("origem_zip", "arquivo", "data_modificacao")
PERIODS = ("ano", "mes")
# What became of a member; an archive whose members were listed has a row of its own.
LISTED, LOADED, REJECTED = "listed", "loaded", "rejected"


@dataclass(frozen=True)
class BronzeTables:
    bronze: str
    failures: str

    @property
    def log(self) -> str:
        return bronze_log(self.bronze)

    @property
    def record(self) -> str:
        return bronze_record(self.bronze)


@dataclass(frozen=True)
class LoadResult:
    """What a load did; true if it took up anything, an archive without members included."""

    archives: int = 0
    accepted: int = 0
    rejected: int = 0
    rows: int = 0
    failures: int = 0

    def __bool__(self) -> bool:
        return self.archives > 0


def bronze_log(bronze: str) -> str:
    """The log of the loads of a bronze table."""
    return f"{bronze}_loads"


def bronze_record(bronze: str) -> str:
    """The record of the members that loads have dealt with."""
    return f"{bronze}_record"


def create_bronze(spark: SparkSession, tables: BronzeTables, table_format: str = "parquet",
                  location: str | None = None) -> None:
    """Bronze, failures, the record of members and the log of loads.

    Bronze is stored by load and period, so that the silver load can read single months.
    """
    def place(name: str) -> str | None:
        return location and f"{location}/{name}"

    create_log(spark, tables.log, table_format, place("loads"))
    # A member is loaded once per name and time, and set aside once per archive, name and time.
    taken, version = f"estado = '{LOADED}'", list(layouts.FILE_VERSION)
    stated = ["estado", f"CASE WHEN {taken} THEN NULL ELSE origem_zip END", *version]
    for table, columns, periods, name, claims in (
            (tables.record, layouts.RECORD_COLUMNS, (), "record", Claims(tables.record, stated)),
            (tables.bronze, layouts.BRONZE_COLUMNS, PERIODS, "bronze", Claims(tables.record, version, where=taken)),
            (tables.failures, layouts.FAILURE_COLUMNS, (), "failures", Claims(tables.record, FILE, where=f"NOT {taken}"))):
        create_loaded_table(spark, table, columns, tables.log, periods, table_format, place(name), claims)


def bronze_projection(rows: DataFrame) -> DataFrame:
    """Checked rows in the layout of the bronze table, lineage and period columns included."""
    return rows.select(
        *(F.col(rule.column).try_cast(rule.kind).alias(rule.column) if rule.kind != "string" else F.col(rule.column)
          for rule in layouts.REPORT_RULES),
        "arquivo", "data_modificacao",
        *(c.alias(n) for n, c in period_columns(F.col("DT_COMPTC")).items()), *layouts.OPTIONAL_COLUMNS)


def recorded(spark: SparkSession, tables: BronzeTables) -> DataFrame:
    return finished_rows(spark, tables.record, tables.log)


def bronze_rows(spark: SparkSession, bronze: str) -> DataFrame:
    """The bronze table as it is now."""
    return finished_rows(spark, bronze, bronze_log(bronze), bronze_record(bronze))


def unseen_archives(spark: SparkSession, tables: BronzeTables, manifest: DataFrame) -> DataFrame:
    """Archives of the manifest that no finished load has listed in this version; the others are not opened."""
    seen = recorded(spark, tables).where(F.col("estado") == LISTED).select("origem_zip", "data_modificacao")
    named = manifest.withColumn("origem_zip", strip_extension(F.col("arquivo")))
    return unseen_versions(named, seen, ["origem_zip", "data_modificacao"]).select(*manifest.columns)


def unseen_members(spark: SparkSession, tables: BronzeTables, entries: DataFrame) -> DataFrame:
    """Members whose (name, archive time) is not loaded and that were not rejected in this version of the archive."""
    record, version = recorded(spark, tables), ["nome_arquivo", "archive_mtime"]
    loaded = record.where(F.col("estado") == LOADED).select(*layouts.FILE_VERSION).toDF(*version)
    rejected = record.where(F.col("estado") == REJECTED).select(*FILE).toDF("origem_zip", *version)
    unseen = unseen_versions(entries, loaded, version)
    return unseen_versions(unseen, rejected, ["origem_zip", *version])


def unreadable(rows: DataFrame, check_name: str) -> DataFrame:
    """Failures of files that could not be read; ``rows`` has FILE and ``problem``."""
    return rows.select(*FILE, F.lit(None).cast("bigint").alias("row_id"), F.lit(None).cast("string").alias("column_name"),
                       F.lit(check_name).alias("check_name"), F.col("problem").alias("failure_case"))


def report_failures(staged: DataFrame) -> DataFrame:
    """All failures of staged rows: lacking columns, bad values, rows longer than the header, members that broke off."""
    too_long = failure(F.col("surplus") > 0, F.lit(None), "field_count", F.col("surplus").cast("string"))
    return (value_failures(data_rows(staged), layouts.REPORT_RULES, FILE, "row_id", F.col("absent"), [too_long])
            .unionByName(missing_columns(member_rows(staged), FILE))
            .unionByName(unreadable(unreadable_members(staged), "member_unreadable")))


def stage_members(spark: SparkSession, entries: DataFrame, task_bytes: int = TASK_BYTES, max_tasks: int = MAX_TASKS,
                  folder: str | None = None) -> DataFrame:
    """Rows of the members, decoded once and written to the shared folder; checking and loading both read them there."""
    chunks = new_folder(spark, "chunks")
    rows = all_rows(settle(entries), layouts.REPORT_COLUMNS + layouts.OPTIONAL_COLUMNS, chunks, layouts.REPORT_RENAMES,
                    layouts.REPORT_COLUMNS, missing=layouts.MISSING_TEXTS, task_bytes=task_bytes, max_tasks=max_tasks)
    rows = rows.withColumnRenamed("archive_mtime", "data_modificacao").drop("entry_mtime")
    folder = folder or new_folder(spark, "staged")
    rows.write.parquet(folder)
    if folder_exists(spark, chunks):
        remove_folder(spark, chunks)
    return spark.read.schema(rows.schema).parquet(folder)


def member_record(members: DataFrame, rows: DataFrame, failures: DataFrame) -> DataFrame:
    """A row per member: whether it was taken, its rows and their months (none if it was not), its failures.

    All three are counted in one aggregation, which each task begins with its own rows.
    """
    def counted(frame: DataFrame, row: int, fault: int, *period: Column) -> DataFrame:
        none = F.lit(None).cast("int")
        ano, mes = period or (none, none)
        return frame.select(*FILE, F.lit(row).alias("row"), F.lit(fault).alias("fault"), F.when(
            F.lit(row) == 1, F.struct(ano.alias("ano"), mes.alias("mes"))).alias("month"))

    every = (counted(members, 0, 0).unionByName(counted(failures, 0, 1))
             .unionByName(counted(rows, 1, 0, *period_columns(F.col("DT_COMPTC")).values())))
    found = every.groupBy(*FILE).agg(F.sum("row").alias("n"), F.sum("fault").alias("falhas"), F.collect_set("month").alias("months"))
    taken = F.col("falhas") == 0
    return found.select(*FILE, F.when(taken, LOADED).otherwise(REJECTED).alias("estado"),
                        F.when(taken, F.col("n")).otherwise(0).alias("linhas"), "falhas",
                        F.when(taken, F.col("months")).otherwise(F.array()).alias("meses"))


def append_rows(spark: SparkSession, rows: DataFrame, tables: BronzeTables) -> None:
    """Add rows in the layout of bronze as a load of their own, for instance to take over an existing table.

    They have no record, so no other load has a claim to them.
    """
    load = begin_load(spark, tables.log)
    append_part(rows, tables.bronze, load)
    finish_load(spark, tables.log, load, changed_months(spark, tables, load))


def changed_months(spark: SparkSession, tables: BronzeTables, load: Load) -> list[tuple[int | None, int | None]]:
    """Months of the load's rows, from the names of its partitions; as many as the calendar has at most."""
    months = part_rows(spark, tables.bronze, load).select(*PERIODS).distinct()
    return [(row.ano, row.mes) for row in months.collect()]


@dataclass(frozen=True)
class Taken:
    """A load that has begun, and the archives that are new to it."""

    load: Load
    archives: DataFrame
    count: int


def begin_bronze(spark: SparkSession, landing: str, tables: BronzeTables, suffix: str = ".zip") -> Taken | None:
    """Begin a load of the archives that are new in the landing folder; none if there are no such."""
    manifest = landing_manifest(spark, landing, suffix)
    before = log_state(spark, tables.log).done
    fresh = settle(unseen_archives(spark, tables, manifest))
    if fresh.isEmpty():
        log.info("nothing new in %s", landing)
        return None
    load = begin_load(spark, tables.log)
    if log_state(spark, tables.log).done != before:
        # A load has finished in between; from here on the two know of each other.
        fresh = settle(unseen_archives(spark, tables, fresh))
    return Taken(load, fresh, fresh.count())


def complete_bronze(spark: SparkSession, taken: Taken, tables: BronzeTables, task_bytes: int = TASK_BYTES,
                    max_tasks: int = MAX_TASKS, discard_staged: bool = False) -> LoadResult:
    """Load what :func:`begin_bronze` has found."""
    load, fresh = taken.load, taken.archives
    listed = settle(listed_archives(fresh))
    whole = listed.where("problem IS NULL").drop("problem")
    broken = listed.where("problem IS NOT NULL").select(
        "origem_zip", F.lit(None).cast("string").alias("arquivo"), F.col("archive_mtime").alias("data_modificacao"), "problem")
    folder = new_folder(spark, "staged")
    staged = stage_members(spark, unseen_members(spark, tables, whole), task_bytes, max_tasks, folder)
    append_part(report_failures(staged).unionByName(unreadable(broken, "archive_unreadable")), tables.failures, load)
    failures = part_rows(spark, tables.failures, load).where("arquivo IS NOT NULL")
    append_part(bronze_projection(accepted_rows(data_rows(staged), failures, FILE)), tables.bronze, load)

    members = member_record(staged.where("row_id IS NULL"), data_rows(staged), failures)
    every = fresh.select(strip_extension(F.col("arquivo")).alias("origem_zip"), F.lit(None).cast("string").alias("arquivo"),
                         "data_modificacao", F.lit(LISTED).alias("estado"), F.lit(0).cast("bigint").alias("linhas"),
                         F.lit(0).cast("bigint").alias("falhas"),
                         F.array().cast(members.schema["meses"].dataType).alias("meses"))
    append_part(members.unionByName(every), tables.record, load)
    done = part_rows(spark, tables.record, load).where(F.col("estado") != LISTED).agg(
        F.count_if(F.col("estado") == LOADED).alias("accepted"), F.count_if(F.col("estado") == REJECTED).alias("rejected"),
        F.coalesce(F.sum("linhas"), F.lit(0)).alias("rows"), F.coalesce(F.sum("falhas"), F.lit(0)).alias("failures"),
        F.array_distinct(F.flatten(F.collect_set("meses"))).alias("months")).first()
    finish_load(spark, tables.log, load, [(month.ano, month.mes) for month in done.months])
    if discard_staged:
        remove_folder(spark, folder)
    return LoadResult(taken.count, done.accepted, done.rejected, done.rows, done.failures)


def load_bronze(spark: SparkSession, landing: str, tables: BronzeTables, suffix: str = ".zip",
                task_bytes: int = TASK_BYTES, max_tasks: int = MAX_TASKS, discard_staged: bool = False) -> LoadResult:
    """Append the rows of members that are new in the landing folder; the result is false when there was nothing new.

    A file with any failure is recorded and left out whole, one that cannot be read included. Everything is stored under
    the number of the load, and counts once the load is finished: a run that breaks off has done nothing, and the next one
    takes the same files up again. Loads may run side by side: a file that two of them take up counts once, for the first to
    finish. With ``discard_staged`` the decoded copy of the load is deleted once it has finished.
    """
    taken = begin_bronze(spark, landing, tables, suffix)
    return complete_bronze(spark, taken, tables, task_bytes, max_tasks, discard_staged) if taken else LoadResult()


def merge_bronze(spark: SparkSession, tables: BronzeTables) -> bool:
    """Rewrite bronze, failures and record as one load; the months stay what they were for the feed of silver."""
    periods = {tables.bronze: PERIODS}
    return merge_loads(spark, (tables.record, tables.failures, tables.bronze), tables.log, periods, tables.record) is not None
