"""Tables whose rows count only when the load that wrote them has finished.

Appending files is not atomic, so a load that breaks off can leave part of its rows. Rows are therefore stored under the
number of their load, in ``<table>_parts``, and the table itself is a view of finished loads. A load is finished by one row
in the log, a single small file that appears whole or not at all, written after everything else. What an unfinished load
has left is never seen; its files are not recorded, so the next run takes them up again from the start.

Two loads may run at the same time and take up the same files. Each notes, right after it has begun and before it looks
for what is new, which other loads have begun and not finished. Of two loads that do not know of each other's work at least
one therefore names the other. Rows of such loads count only in the first of them to finish that holds the same claim, for
instance the same file version; the view settles it, so nothing has to be locked. All other loads are read as they are.

A load can also stand for earlier ones, whose rows it has rewritten (:func:`merge_loads`).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.tables import append_by_name, create_table, current_table

LOAD = "carga"
MONTHS = "meses ARRAY<STRUCT<ano: INT, mes: INT>>"
#: ``ao_lado``: loads that had begun and not finished when this one began; ``cobre``: loads of another log that this one
#: has taken up; ``substitui``: loads whose rows this one has taken over.
LOG_COLUMNS = (f"{LOAD} STRING, estado STRING, momento TIMESTAMP, {MONTHS}, ao_lado ARRAY<STRING>, cobre ARRAY<STRING>, "
               "substitui ARRAY<STRING>")
BEGUN, FINISHED = "begun", "finished"


@dataclass(frozen=True)
class Load:
    """A load that has begun, and the unfinished ones that it has found beside it."""

    number: str
    beside: tuple[str, ...] = ()


@dataclass(frozen=True)
class Claims:
    """What a row of a loaded table belongs to, and where loads hold such claims.

    ``keys`` are expressions over the rows of ``table`` that fulfil ``where``, ``own`` the same over the rows to be settled.
    """

    table: str
    keys: Sequence[str]
    own: Sequence[str] = ()
    where: str = "TRUE"


def parts_of(table: str) -> str:
    return f"{table}_parts"


def counted_of(table: str) -> str:
    """The view of the rows that count, with the load that each belongs to."""
    return f"{table}_counted"


def done_of(log: str) -> str:
    """The view of finished loads that no other one has replaced."""
    return f"{log}_done"


def shared_of(log: str) -> str:
    """The view of those of them that ran beside another one."""
    return f"{log}_shared"


def create_log(spark: SparkSession, log: str, table_format: str = "parquet", location: str | None = None) -> None:
    create_table(spark, log, LOG_COLUMNS, (), table_format, location)
    finished = f"{log} WHERE estado = '{FINISHED}'"
    spark.sql(f"""CREATE OR REPLACE VIEW {done_of(log)} AS
        SELECT f.{LOAD}, momento, ao_lado FROM (SELECT * FROM {finished}) f
        LEFT ANTI JOIN (SELECT explode(substitui) AS {LOAD} FROM {finished}) r ON f.{LOAD} = r.{LOAD}""")
    spark.sql(f"""CREATE OR REPLACE VIEW {shared_of(log)} AS
        WITH met AS (SELECT a.{LOAD}, a.other FROM (SELECT {LOAD}, explode(ao_lado) AS other FROM {done_of(log)}) a
                     JOIN {done_of(log)} b ON a.other = b.{LOAD})
        SELECT {LOAD}, momento FROM {done_of(log)} WHERE {LOAD} IN (SELECT {LOAD} FROM met UNION SELECT other FROM met)""")


def create_loaded_table(spark: SparkSession, table: str, columns: str, log: str, partition_by: Sequence[str] = (),
                        table_format: str = "parquet", location: str | None = None, claims: Claims | None = None) -> None:
    """The stored parts, and the view of those whose load has finished, with just the given columns."""
    create_table(spark, parts_of(table), f"{columns}, {LOAD} STRING", (LOAD, *partition_by), table_format, location)
    # Partition columns come last in a stored table; the views have the order given.
    names = ", ".join(field.name for field in T.StructType.fromDDL(columns))
    done, shared = (f"SELECT {LOAD} FROM {view(log)}" for view in (done_of, shared_of))
    rows = f"SELECT {names}, {LOAD} FROM {parts_of(table)} AS p WHERE {LOAD} IN"
    if claims is None:
        query = f"{rows} ({done})"
    else:
        keys = ", ".join(f"{key} AS k{i}" for i, key in enumerate(claims.keys))
        labels = ", ".join(f"k{i}" for i in range(len(claims.keys)))
        same = " AND ".join(f"l.k{i} <=> {own}" for i, own in enumerate(claims.own or claims.keys))
        # Claims of loads that ran beside others; one that an earlier load holds is lost.
        held = (f"SELECT c.{LOAD}, s.momento, {keys} FROM {parts_of(claims.table)} c JOIN {shared_of(log)} s "
                f"ON c.{LOAD} = s.{LOAD} WHERE {claims.where}")
        first = f"min(struct(momento, {LOAD})) OVER (PARTITION BY {labels})"
        lost = f"SELECT * FROM (SELECT *, {first} AS first FROM ({held})) WHERE first.{LOAD} <> {LOAD}"
        query = (f"{rows} ({done} EXCEPT {shared}) UNION ALL {rows} ({shared}) "
                 f"AND NOT EXISTS (SELECT 1 FROM ({lost}) l WHERE l.{LOAD} = p.{LOAD} AND {same})")
    spark.sql(f"CREATE OR REPLACE VIEW {counted_of(table)} AS {query}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {names} FROM {counted_of(table)}")


@dataclass(frozen=True)
class LogState:
    """What a log says: the loads that count, those of them that ran beside another one, and those that have not finished."""

    done: frozenset[str]
    shared: frozenset[str]
    unfinished: frozenset[str]


def log_state(spark: SparkSession, log: str) -> LogState:
    """The log read once, two short rows for each load ever begun; the views of :func:`create_log` say the same."""
    rows = current_table(spark, log).select(LOAD, "estado", "ao_lado", "substitui").collect()
    finished = {row[LOAD]: row for row in rows if row.estado == FINISHED}
    replaced = {load for row in finished.values() for load in row.substitui or ()}
    done = finished.keys() - replaced
    met = {(load, other) for load in done for other in finished[load].ao_lado or () if other in done}
    return LogState(frozenset(done), frozenset(load for pair in met for load in pair),
                    frozenset({row[LOAD] for row in rows} - finished.keys()))


def finished_rows(spark: SparkSession, table: str, log: str, claims: str | None = None) -> DataFrame:
    """The table as it is now; ``claims`` is the table that holds its claims, if that is another one.

    The loads that count are named in the plan, so that only their partitions are listed and read.
    """
    state = log_state(spark, log)
    parts = current_table(spark, parts_of(table))
    names = [name for name in spark.table(table).columns]
    rows = parts.where(F.col(LOAD).isin(sorted(state.done - state.shared))).select(*names)
    if not state.shared:
        return rows
    current_table(spark, parts_of(claims or table))
    return rows.unionAll(spark.table(counted_of(table)).where(F.col(LOAD).isin(sorted(state.shared))).select(*names))


def _log(spark: SparkSession, log: str, load: str, state: str, months: Sequence[tuple[int | None, int | None]] = (),
         beside: Sequence[str] = (), covers: Sequence[str] = (), replaces: Sequence[str] = ()) -> None:
    row = spark.createDataFrame([(load, state, [{"ano": y, "mes": m} for y, m in months], list(beside), list(covers), list(replaces))],
                                f"{LOAD} STRING, estado STRING, {MONTHS}, ao_lado ARRAY<STRING>, cobre ARRAY<STRING>, "
                                "substitui ARRAY<STRING>")
    append_by_name(row.coalesce(1).withColumn("momento", F.current_timestamp()), log)


def begin_load(spark: SparkSession, log: str) -> Load:
    """A new load. What is new to it has to be looked for afterwards."""
    number = uuid.uuid4().hex
    _log(spark, log, number, BEGUN)
    return Load(number, tuple(sorted(log_state(spark, log).unfinished - {number})))  # they run now, or have broken off


def append_part(rows: DataFrame, table: str, load: Load, cluster_by: Sequence[str] = ()) -> None:
    """Store rows under the load; nobody sees them yet."""
    append_by_name(rows.withColumn(LOAD, F.lit(load.number)), parts_of(table), cluster_by)


def part_rows(spark: SparkSession, table: str, load: Load) -> DataFrame:
    """What the load has stored so far."""
    return current_table(spark, parts_of(table)).where(F.col(LOAD) == load.number).drop(LOAD)


def finish_load(spark: SparkSession, log: str, load: Load, months: Sequence[tuple[int | None, int | None]] = (),
                covers: Sequence[str] = (), replaces: Sequence[str] = ()) -> None:
    """Make all that the load has stored part of its tables; ``months`` are those it has changed."""
    _log(spark, log, load.number, FINISHED, months, load.beside, covers, replaces)


def unfinished_loads(spark: SparkSession, log: str) -> DataFrame:
    """Numbers of loads that have begun and not finished, because they run still or broke off."""
    states = current_table(spark, log).groupBy(LOAD).agg(F.max(F.col("estado") == FINISHED).alias("finished"))
    return states.where("NOT finished").select(LOAD)


def merge_loads(spark: SparkSession, tables: Sequence[str], log: str, cluster_by: dict[str, Sequence[str]] | None = None,
                claims: str | None = None) -> Load | None:
    """Rewrite the rows of all finished loads as those of one load, which stands for them; nothing if there is only one.

    ``tables`` are all tables of the log. Before the new load is finished the old ones count, from then on only the new one,
    so readers see the same rows at any time. The files of the replaced loads stay until :func:`replaced_parts` are deleted.
    """
    load = begin_load(spark, log)
    old = sorted(log_state(spark, log).done)
    if len(old) < 2:
        return None
    for table in tables:
        # What has lost its claim to another load is not taken over, and what finishes meanwhile stays by itself.
        for name in {log, parts_of(table), parts_of(claims or table)}:
            current_table(spark, name)
        rows = spark.table(counted_of(table)).where(F.col(LOAD).isin(old)).drop(LOAD)
        append_part(rows, table, load, (cluster_by or {}).get(table, ()))
    finish_load(spark, log, load, replaces=old)
    return load


def replaced_parts(spark: SparkSession, table: str, log: str) -> DataFrame:
    """``path`` of the files of a table that belong to replaced loads. They may be deleted when no reader needs them."""
    gone = current_table(spark, log).where(F.col("estado") == FINISHED).select(F.explode("substitui").alias(LOAD))
    return (current_table(spark, parts_of(table)).select(LOAD, F.col("_metadata.file_path").alias("path")).distinct()
            .join(gone, LOAD, "left_semi").select("path").distinct())
