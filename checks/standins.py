"""The given tables in the roles of the loads: bronze rows, file lists, and archives packed by Spark tasks."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.layouts import REPORT_COLUMNS
from sluice.sources.archives import open_path

ROWS_PER_ARCHIVE = 5000
TEXTS_PER_ARCHIVE = 500
PACKED = "archive STRING, members BIGINT"

DRIFT_DAY = 10
OLD_HEADER = ";".join(REPORT_COLUMNS)
NEW_HEADER = ";".join([" TP_FUNDO_CLASSE ", "CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", *REPORT_COLUMNS[2:]])


def events_as_bronze(events: DataFrame) -> DataFrame:
    """Events as daily-report rows: user is the fund, the event's day the report date, its time the version."""
    amount = F.col("value").cast("string")
    day = F.col("ts").cast("date").cast("string")
    return events.select(
        F.col("event_type").alias("TP_FUNDO"), F.col("user_id").cast("string").alias("CNPJ_FUNDO"),
        day.alias("DT_COMPTC"), amount.alias("VL_TOTAL"), amount.alias("VL_QUOTA"), amount.alias("VL_PATRIM_LIQ"),
        amount.alias("CAPTC_DIA"), amount.alias("RESG_DIA"), F.col("event_id").alias("NR_COTST"),
        F.concat(F.lit("report_"), day, F.lit(".csv")).alias("arquivo"), F.col("ts").alias("data_modificacao"),
        F.year("ts").alias("ano"), F.month("ts").alias("mes"), F.lit(None).cast("string").alias("ID_SUBCLASSE"))


def before_noon(bronze: DataFrame) -> DataFrame:
    """What an earlier load of the day would have seen."""
    return bronze.filter(F.hour("data_modificacao") < 12)


def delimited(cells: Sequence[Column], quote_all: bool = False) -> Column:
    """Cells as one line of a delimited member; quotes within a cell are doubled."""
    options = {"sep": ";", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "quoteAll": str(quote_all).lower()}
    return F.to_csv(F.struct(*(cell.alias(f"c{i}") for i, cell in enumerate(cells))), options)


def document_lines(documents: DataFrame) -> DataFrame:
    """Documents as lines of archives, a bounded block of documents each."""
    block = F.floor(F.col("doc_id") / TEXTS_PER_ARCHIVE).cast("string")
    cells = [F.col(c).cast("string") for c in ("doc_id", "lang", "source", "n_chars", "text")]
    return documents.select(
        F.concat(F.lit("texts_"), block).alias("archive"), F.concat("source", F.lit(".csv")).alias("member"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("modified"), F.col("doc_id").alias("position"),
        F.lit("doc_id;lang;source;n_chars;text").alias("header"), delimited(cells, quote_all=True).alias("line"))


def report_archive(event_id: Column, rows: int = ROWS_PER_ARCHIVE) -> Column:
    """Name of the archive that holds an event's line."""
    return F.concat(F.lit("reports_"), F.floor(event_id / rows).cast("string"))


def report_lines(events: DataFrame, rows: int = ROWS_PER_ARCHIVE) -> DataFrame:
    """Events as daily-report files: bounded blocks as archives, a member per day and type, header drift with time.

    Every event is a fund of its own. Events of type error come without a quota.
    """
    archive = report_archive(F.col("event_id"), rows)
    day, amount = F.col("ts").cast("date").cast("string"), F.col("value").cast("string")
    user = F.col("user_id").cast("string")
    head = [F.col("event_type"), F.col("event_id").cast("string")]
    tail = [day, amount, F.when(F.col("event_type") == "error", "").otherwise(amount), amount, amount, amount, user]
    newer = F.dayofmonth("ts") >= DRIFT_DAY
    return events.select(
        archive.alias("archive"),
        F.concat(F.lit("daily/"), archive, F.lit("_"), day, F.lit("_"), "event_type", F.lit(".csv")).alias("member"),
        F.date_trunc("HOUR", "ts").alias("modified"), F.col("event_id").alias("position"),
        F.when(newer, NEW_HEADER).otherwise(OLD_HEADER).alias("header"),
        F.when(newer, F.concat_ws(";", *head, F.concat(F.lit("S"), user), *tail))
        .otherwise(F.concat_ws(";", *head, *tail)).alias("line"))


def pack_archives(lines: DataFrame, folder: str, encoding: str = "latin1") -> None:
    """Write each group of lines as one zip archive, from the task that holds it.

    Archives must be bounded groups. A repeated task writes the same archive again, under its final name only when whole.
    """

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        name = key[0].as_py()
        body = io.BytesIO()
        table = table.sort_by([("member", "ascending"), ("position", "ascending")])
        members = pc.unique(table["member"]).to_pylist()
        with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as archive:
            for member in members:
                part = table.filter(pc.equal(table["member"], member))
                info = zipfile.ZipInfo(member, pc.max(part["modified"]).as_py().timetuple()[:6])
                text = "\n".join([part["header"][0].as_py(), *part["line"].to_pylist(), ""])
                archive.writestr(info, text.encode(encoding), zipfile.ZIP_DEFLATED)
        system, inner = open_path(folder)
        system.create_dir(inner)
        # A name of its own for each attempt, as two may run at the same time.
        part = f"{inner}/{name}.{uuid.uuid4().hex}.part"
        with system.open_output_stream(part) as out:
            out.write(body.getbuffer())
        system.move(part, f"{inner}/{name}.zip")
        return pa.table({"archive": [name], "members": pa.array([len(members)], pa.int64())})

    lines.groupBy("archive").applyInArrow(pack, PACKED).agg(F.sum("members")).first()
