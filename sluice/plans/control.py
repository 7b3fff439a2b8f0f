"""Ingestion control: every member of every archive, landed once per version and recorded."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import layouts
from sluice.functions.names import strip_extension
from sluice.operators.joins import lookup_join, settle
from sluice.operators.loads import (Claims, Load, append_part, begin_load, create_loaded_table, create_log, finish_load,
                                    finished_rows, log_state, part_rows)
from sluice.operators.manifest import exclude_names, ingest_plan
from sluice.operators.versions import unseen_versions
from sluice.plans.bronze import LISTED
from sluice.sources.archives import CONTENT_CHUNK, MAX_TASKS, TASK_BYTES, listed_archives, member_contents
from sluice.sources.landing import landing_manifest
from sluice.sources.portal import portal_links

ARCHIVE = ("origem_zip", "data_modificacao")
ARCHIVE_COLUMNS = "origem_zip STRING, data_modificacao TIMESTAMP, estado STRING, problema STRING"
REJECTED = "archive_unreadable"


@dataclass(frozen=True)
class ControlTables:
    control: str
    members: str

    @property
    def log(self) -> str:
        return f"{self.control}_loads"

    @property
    def archives(self) -> str:
        return f"{self.control}_archives"


@dataclass(frozen=True)
class ControlResult:
    """What a load did; true if it took up any archive."""

    archives: int = 0
    unreadable: int = 0
    members: int = 0

    def __bool__(self) -> bool:
        return self.archives > 0


def create_control(spark: SparkSession, tables: ControlTables, table_format: str = "parquet",
                   location: str | None = None) -> None:
    """The control table, the landed members, the archives dealt with, and the log of loads."""
    def place(name: str) -> str | None:
        return location and f"{location}/{name}"

    create_log(spark, tables.log, table_format, place("loads"))
    # A member is recorded and landed once per name and time, an archive per name and time of its own.
    version = Claims(tables.control, layouts.MEMBER_VERSION)
    for table, columns, name, claims in ((tables.control, layouts.CONTROL_COLUMNS, "control", version),
                                         (tables.members, layouts.MEMBER_CONTENT_COLUMNS, "members", version),
                                         (tables.archives, ARCHIVE_COLUMNS, "archives", Claims(tables.archives, ARCHIVE))):
        create_loaded_table(spark, table, columns, tables.log, (), table_format, place(name), claims)


def member_metadata(entries: DataFrame) -> DataFrame:
    """Archive members in the layout of the control table; the time is the member's own."""
    return entries.select("nome_arquivo", F.col("entry_mtime").cast("timestamp").alias("data_modificacao"),
                          "origem_zip", "tamanho_bytes", "arquivo_ingestao")


def destinations(pages: DataFrame, base: Column, folder: Column, suffix: str = ".zip", order: Sequence[str] = (),
                 exclude: Sequence[str] = ()) -> DataFrame:
    """``nome_arquivo``, ``caminho_completo``: each archive that the pages link to, once, without those left out.

    ``folder`` may use ``arquivo`` and ``url`` of a link; of several links to a name the last in page order counts.
    """
    links = portal_links(pages, base, suffix, order=tuple(order)).withColumnRenamed("arquivo", "nome_arquivo")
    return exclude_names(ingest_plan(links, folder, [*order, "position"]), exclude)


def run_control(spark: SparkSession, plan: DataFrame, landing: str, tables: ControlTables,
                fetch: Callable[[DataFrame], None], **how) -> ControlResult:
    """Hand the plan of :func:`destinations` to ``fetch``, then load the archives of the plan from the landing folder.

    The destination of an archive stays with its members. Archives that have landed and are not in the plan are left out.
    """
    plan = settle(plan)
    fetch(plan)
    names = plan.select(F.col("nome_arquivo").alias("origem_zip"), F.col("caminho_completo").alias("caminho_destino"))
    manifest = landing_manifest(spark, landing).withColumn("origem_zip", strip_extension(F.col("arquivo")))
    wanted = lookup_join(manifest, names.select("origem_zip"), ["origem_zip"], "left_semi").drop("origem_zip")
    return load_control(spark, wanted, tables, destination=names, **how)


@dataclass(frozen=True)
class Taken:
    """A load that has begun, and the archives that are new to it."""

    load: Load
    archives: DataFrame
    count: int


def unseen_archives(spark: SparkSession, tables: ControlTables, manifest: DataFrame) -> DataFrame:
    """Archives of the manifest that no finished load has dealt with in this version."""
    seen = finished_rows(spark, tables.archives, tables.log).select(*ARCHIVE)
    named = manifest.withColumn("origem_zip", strip_extension(F.col("arquivo")))
    return unseen_versions(named, seen, ARCHIVE).select(*manifest.columns)


def begin_control(spark: SparkSession, manifest: DataFrame, tables: ControlTables, exclude: Sequence[str] = ()) -> Taken | None:
    """Begin a load of the archives of the manifest that are new; none if there are no such."""
    before = log_state(spark, tables.log).done
    named = exclude_names(manifest.withColumn("origem_zip", strip_extension(F.col("arquivo"))), exclude, "origem_zip")
    fresh = settle(unseen_archives(spark, tables, named.drop("origem_zip")))
    if fresh.isEmpty():
        return None
    load = begin_load(spark, tables.log)
    if log_state(spark, tables.log).done != before:
        # A load has finished in between; from here on the two know of each other.
        fresh = settle(unseen_archives(spark, tables, fresh))
    return Taken(load, fresh, fresh.count())


def load_control(spark: SparkSession, manifest: DataFrame, tables: ControlTables, exclude: Sequence[str] = (),
                 destination: DataFrame | None = None, task_bytes: int = TASK_BYTES, max_tasks: int = MAX_TASKS,
                 chunk_bytes: int = CONTENT_CHUNK) -> ControlResult:
    """Land the members that are not recorded yet, and record them.

    Archives that a finished load has dealt with are not opened again. A member that cannot be read is recorded with its
    state, and what is stored of it is not to be used; an archive that cannot be read is told in the list of archives. All
    of it counts once the load is finished; a run that breaks off has landed nothing. Loads may run side by side: a member
    that two of them take up counts once, for the first to finish.
    """
    taken = begin_control(spark, manifest, tables, exclude)
    return (complete_control(spark, taken, tables, destination, task_bytes, max_tasks, chunk_bytes) if taken
            else ControlResult())


def complete_control(spark: SparkSession, taken: Taken, tables: ControlTables, destination: DataFrame | None = None,
                     task_bytes: int = TASK_BYTES, max_tasks: int = MAX_TASKS,
                     chunk_bytes: int = CONTENT_CHUNK) -> ControlResult:
    """Load what :func:`begin_control` has found."""
    version, load, fresh = list(layouts.MEMBER_VERSION), taken.load, taken.archives
    listed = settle(listed_archives(fresh))
    entries = listed.where("problem IS NULL").drop("problem")
    recorded = finished_rows(spark, tables.control, tables.log)
    unseen = settle(unseen_versions(member_metadata(entries), recorded, version))

    dated = entries.withColumn("data_modificacao", F.col("entry_mtime").cast("timestamp"))
    wanted = dated.join(unseen.select(*version).distinct(), version, "left_semi")
    contents = member_contents(wanted.drop("data_modificacao"), task_bytes, max_tasks, chunk_bytes)
    contents = contents.withColumn("data_modificacao", F.col("entry_mtime").cast("timestamp")).drop("entry_mtime")
    if destination is not None:
        contents = lookup_join(contents, destination, ["origem_zip"], "left")
    append_part(contents.withColumnRenamed("problem", "problema"), tables.members, load)
    broken = part_rows(spark, tables.members, load).where("problema IS NOT NULL").select("origem_zip", *version)
    state = unseen.join(broken.distinct().withColumn("situacao_arquivo", F.lit("member_unreadable")),
                        ["origem_zip", *version], "left")
    append_part(state, tables.control, load)
    problems = listed.where("problem IS NOT NULL").select("origem_zip", F.col("archive_mtime").alias("data_modificacao"),
                                                          F.col("problem").alias("problema"))
    archives = (fresh.withColumn("origem_zip", strip_extension(F.col("arquivo"))).select(*ARCHIVE).distinct()
                .join(problems, list(ARCHIVE), "left")
                .withColumn("estado", F.when(F.col("problema").isNull(), LISTED).otherwise(REJECTED)))
    append_part(archives, tables.archives, load)
    unreadable, members = problems.count(), unseen.count()
    finish_load(spark, tables.log, load)
    return ControlResult(taken.count, unreadable, members)
