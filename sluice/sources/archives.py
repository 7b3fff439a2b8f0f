"""Members of zip archives, read where the executors are.

A task gets paths, not contents: listing touches only an archive's directory, and every member is its own unit of work,
streamed in batches. So neither archive nor member has to fit in memory or in one row. Executors must be able to open
the paths (local or mounted folders, or a store that Arrow's file systems know).
"""

from __future__ import annotations

import csv
import io
import lzma
import struct
import sys
import zipfile
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.csv as pa_csv
import pyarrow.fs as pa_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.names import ingest_name, strip_extension
from sluice.operators.quality import standard_names
from sluice.operators.joins import settle

READ_BUFFER = 1 << 20
CSV_BLOCK = 32 << 20  # a member with a longer row is set aside
CONTENT_CHUNK = 4 << 20
TASK_BYTES = 128 << 20
TASK_MEMBERS = 10_000
MAX_TASKS = 10_000
# From so many tasks on, each gets so many bytes: starting a task takes longer than reading a small member.
MANY_TASKS = 64
WORTH_BYTES = 4 << 20
ZIP_EPOCH = datetime(1980, 1, 1)
SCHEME_ALIASES = {"s3a": "s3", "s3n": "s3"}

# What tells that the bytes of an archive or member are no good. Errors of the store are others, and are raised.
UNREADABLE = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, NotImplementedError, UnicodeError, struct.error,
              csv.Error, pa.ArrowInvalid)
ENCRYPTED = 1

ENTRY = ("path STRING, arquivo STRING, archive_mtime TIMESTAMP, entry_no BIGINT, nome_arquivo STRING, "
         "entry_mtime TIMESTAMP_NTZ, tamanho_bytes BIGINT, bytes_before BIGINT, problem STRING")


def open_path(path: str) -> tuple[pa_fs.FileSystem, str]:
    """File system of a Hadoop-style path, and the path within it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return pa_fs.LocalFileSystem(), path
    if scheme == "file":
        return pa_fs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, inner = rest.lstrip("/").partition("/")
    system, root = pa_fs.FileSystem.from_uri(f"{SCHEME_ALIASES.get(scheme, scheme)}://{authority}/")
    return system, f"{root.rstrip('/')}/{inner}"


def open_archive(path: str) -> zipfile.ZipFile:
    system, inner = open_path(path)
    return zipfile.ZipFile(io.BufferedReader(system.open_input_file(inner), READ_BUFFER))


def _entry_time(info: zipfile.ZipInfo) -> datetime:
    try:
        return datetime(*info.date_time)
    except ValueError:  # no time was stored
        return ZIP_EPOCH


def _list_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.to_pylist():
            infos, problem = [], None
            try:
                with open_archive(archive["path"]) as opened:
                    infos = opened.infolist()
            except UNREADABLE as error:
                problem = str(error)
            if problem is not None:
                lone = {name: archive[name] for name in ("path", "arquivo", "archive_mtime")}
                yield pa.RecordBatch.from_pylist([lone | {"problem": problem}], schema=ENTRY_SCHEMA)
                continue
            columns = {name: pa.array([archive[name]] * len(infos), batch.schema.field(name).type)
                       for name in ("path", "arquivo", "archive_mtime")}
            columns["entry_no"] = pa.array(range(len(infos)), pa.int64())
            columns["nome_arquivo"] = pa.array([info.filename for info in infos], pa.string())
            columns["entry_mtime"] = pa.array([_entry_time(info) for info in infos], pa.timestamp("us"))
            sizes = np.array([info.file_size for info in infos], dtype=np.int64)
            columns["tamanho_bytes"] = pa.array(sizes)
            columns["bytes_before"] = pa.array(np.cumsum(sizes) - sizes)
            columns["problem"] = pa.nulls(len(infos), pa.string())
            yield pa.RecordBatch.from_pydict(columns)


def listed_archives(manifest: DataFrame) -> DataFrame:
    """As :func:`archive_entries`, with one row more, and its ``problem``, for each archive that cannot be read."""
    archives = manifest.select("path", "arquivo", F.col("data_modificacao").alias("archive_mtime"))
    return (archives.mapInArrow(_list_entries, ENTRY)
            .withColumn("origem_zip", strip_extension(F.col("arquivo")))
            .withColumn("arquivo_ingestao", ingest_name(F.col("nome_arquivo"), F.col("entry_mtime"))))


def archive_entries(manifest: DataFrame) -> DataFrame:
    """One row per member of every archive in a landing manifest: where it is, its name, time and size.

    ``archive_mtime`` is when the archive landed, ``entry_mtime`` the time the archive gives for the member. Archives
    that cannot be read have no members.
    """
    return listed_archives(manifest).where("problem IS NULL").drop("problem")


def dealt(units: DataFrame, keys: Sequence[str], size: Column, max_tasks: int = MAX_TASKS) -> DataFrame:
    """Units of work, known by their keys, over tasks: one each, unless that would be many tasks of few bytes."""
    found = units.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    tasks = min(max_tasks, max(1, found.n))
    cores = units.sparkSession.sparkContext.defaultParallelism
    enough = max(MANY_TASKS, 4 * cores, found.bytes // WORTH_BYTES)
    # By hash large units, which are often neighbours, come apart; ranges hold the same number of units.
    return units.repartition(enough, *keys) if enough < tasks else units.repartitionByRange(tasks, *keys)


def spread_members(entries: DataFrame, columns: Sequence[str], task_bytes: int = TASK_BYTES,
                   max_tasks: int = MAX_TASKS) -> DataFrame:
    """File members, folders left out, as one row per stretch of an archive and task: ``path`` and ``members``.

    Neighbours in an archive go together up to ``task_bytes``, so that many small members share one opening of it; a
    large member is on its own. Every task gets the same number of stretches: one, as long as there are no more than
    ``max_tasks`` of them. Many small ones share tasks (:func:`dealt`). Their number only groups the work; the rows are
    the same.
    """
    files = entries.filter(~F.col("nome_arquivo").endswith("/"))
    stretches = settle(files.groupBy("path", F.floor(F.col("bytes_before") / task_bytes).alias("stretch"),
                                     F.floor(F.col("entry_no") / TASK_MEMBERS).alias("block"))
                       .agg(F.sort_array(F.collect_list(F.struct("entry_no", *columns))).alias("members"),
                            F.sum("tamanho_bytes").alias("bytes")))
    return dealt(stretches, ["path", "stretch", "block"], F.col("bytes"), max_tasks).select("path", "members")


def _each_member(batches: Iterator[pa.RecordBatch], read: Callable, failed: Callable) -> Iterator[pa.RecordBatch]:
    """Open every listed member and pass it on; ``failed`` gets those that cannot be read, and why."""
    csv.field_size_limit(sys.maxsize)
    for batch in batches:
        for stretch in batch.to_pylist():
            with open_archive(stretch["path"]) as archive:
                infos = archive.infolist()
                for entry in stretch["members"]:
                    info = infos[entry["entry_no"]]
                    if info.filename != entry["nome_arquivo"]:
                        raise RuntimeError(f"{stretch['path']} was replaced while it was being read")
                    try:
                        if info.flag_bits & ENCRYPTED:
                            raise zipfile.BadZipFile("the member is encrypted")
                        with archive.open(info) as member:
                            yield from read(entry, member)
                    except UNREADABLE as error:
                        yield failed(entry, str(error))
                    except OSError as error:
                        # What the bzip2 module raises for bad bytes; the store's errors have numbers or other words.
                        if info.compress_type != zipfile.ZIP_BZIP2 or str(error) != "Invalid data stream":
                            raise
                        yield failed(entry, str(error))


def _read_header(member, encoding: str, sep: str) -> list[str]:
    for line in member:
        if line.strip():
            return next(csv.reader([line.decode(encoding)], delimiter=sep))
    return []


class _Prefixed(io.RawIOBase):
    """A stream with some bytes put before it."""

    def __init__(self, prefix: bytes, stream):
        self.prefix, self.stream = prefix, stream

    def readable(self) -> bool:
        return True

    def read(self, size: int = -1) -> bytes:
        if self.prefix:
            prefix, self.prefix = self.prefix, b""
            return prefix
        return self.stream.read(size)


Cells = tuple[np.ndarray, pa.Array, list[pa.Array]]


def _read_table(member, raw_names: list[str], wanted: list[str], encoding: str, sep: str, missing: Sequence[str],
                block: int | None = None) -> Iterator[Cells]:
    """Batches of row numbers, numbers of surplus fields, and the wanted columns as text.

    Rows are numbered from 0 in file order. The reader sets irregular rows aside; they are passed on after every block,
    so that no more of them than a block holds are kept. It starts with a row of our own, numbered -1, because it would
    read on to the first regular one before it gives anything.
    """
    irregular: list[pa_csv.InvalidRow] = []

    def set_aside(row: pa_csv.InvalidRow) -> str:
        irregular.append(row)
        return "skip"

    first = (sep.join(['""'] * len(raw_names)) + "\n").encode(encoding)
    reader = pa_csv.open_csv(
        _Prefixed(first, member),
        read_options=pa_csv.ReadOptions(column_names=raw_names, encoding=encoding, use_threads=False,
                                        block_size=block or CSV_BLOCK),
        parse_options=pa_csv.ParseOptions(delimiter=sep, newlines_in_values=True, invalid_row_handler=set_aside),
        convert_options=pa_csv.ConvertOptions(column_types={name: pa.string() for name in raw_names},
                                              include_columns=wanted, null_values=list(missing),
                                              strings_can_be_null=True, quoted_strings_can_be_null=True))
    position, taken = -1, np.empty(0, dtype=np.int64)
    for batch in reader:
        drained = irregular.copy()
        irregular.clear()
        # The reader may be a block ahead, so numbers of irregular rows are kept until they are passed.
        taken = np.concatenate([taken, np.array([row.number - 2 for row in drained], dtype=np.int64)])
        numbers = np.setdiff1d(np.arange(position, position + batch.num_rows + len(taken)), taken)[:batch.num_rows]
        if len(numbers):
            taken = taken[taken > numbers[-1]]
            skipped = 1 if position == -1 else 0
            position = int(numbers[-1]) + 1
            if len(numbers) > skipped:
                yield (numbers[skipped:], pa.nulls(len(numbers) - skipped, pa.int64()),
                       [column.slice(skipped) for column in batch.columns])
        passed = int(np.sum(taken == position + np.arange(len(taken))))
        position, taken = position + passed, taken[passed:]
        if drained:
            yield _irregular_cells(drained, raw_names, wanted, sep, missing)


def _irregular_cells(rows: Sequence[pa_csv.InvalidRow], raw_names: list[str], wanted: list[str], sep: str,
                     missing: Sequence[str]) -> Cells:
    """Rows with too few fields, filled up, or with too many, counted."""
    fields = [dict(zip(raw_names, next(csv.reader(io.StringIO(row.text, newline=""), delimiter=sep)))) for row in rows]
    columns = [[None if text in missing else text for text in (cells.get(name) for cells in fields)] for name in wanted]
    surplus = [max(row.actual_columns - len(raw_names), 0) or None for row in rows]
    return (np.array([row.number - 2 for row in rows], dtype=np.int64), pa.array(surplus, pa.int64()),
            [pa.array(column, pa.string()) for column in columns])


def rows_schema(columns: Sequence[str]) -> str:
    return ("origem_zip STRING, arquivo STRING, archive_mtime TIMESTAMP, entry_mtime TIMESTAMP_NTZ, row_id BIGINT, "
            "surplus BIGINT, absent ARRAY<STRING>, problem STRING, " + ", ".join(f"`{name}` STRING" for name in columns))


def row_batches(columns: Sequence[str]) -> Callable[..., pa.RecordBatch]:
    """Makes batches of :func:`rows_schema`, with nulls in the columns that the cells lack."""
    columns = list(columns)

    def rows_of(entry: dict, absent, problem: str | None, row_ids: pa.Array, surplus: pa.Array,
                cells: Mapping[str, pa.Array]) -> pa.RecordBatch:
        size = len(row_ids)
        data = {"origem_zip": pa.repeat(pa.scalar(entry["origem_zip"], pa.string()), size),
                "arquivo": pa.repeat(pa.scalar(entry["nome_arquivo"], pa.string()), size),
                "archive_mtime": pa.repeat(pa.scalar(entry["archive_mtime"], pa.timestamp("us", tz="UTC")), size),
                "entry_mtime": pa.repeat(pa.scalar(entry["entry_mtime"], pa.timestamp("us")), size),
                "row_id": row_ids, "surplus": surplus,
                "absent": pa.repeat(pa.scalar(absent, pa.list_(pa.string())), size),
                "problem": pa.repeat(pa.scalar(problem, pa.string()), size)}
        data.update({name: cells.get(name, pa.nulls(size, pa.string())) for name in columns})
        return pa.RecordBatch.from_pydict(data)

    return rows_of


def archive_rows(entries: DataFrame, columns: Sequence[str], renames: Mapping[str, str] | None = None,
                 required: Sequence[str] = (), sep: str = ";", encoding: str = "latin1",
                 missing: Sequence[str] = ("",), task_bytes: int = TASK_BYTES,
                 max_tasks: int = MAX_TASKS) -> DataFrame:
    """Rows of the delimited members, all cells as text.

    Header names are cleaned and mapped per member, so members with differing headers come out under the same
    ``columns``. A cell of a column the member lacks is null; ``absent`` lists those of them that are ``required``. A
    row shorter than the header is filled with nulls, ``surplus`` counts the fields of a row beyond the header. Every
    member also gives one row without ``row_id``, so that one without data is not lost. A member that cannot be read
    to its end gives another one with its ``problem``; rows before the fault may be there.
    """
    columns, renames, required, missing = list(columns), dict(renames or {}), list(required), list(missing)
    rows_of = row_batches(columns)

    def failed(entry: dict, problem: str) -> pa.RecordBatch:
        return rows_of(entry, None, problem, pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), {})

    def read(entry: dict, member) -> Iterator[pa.RecordBatch]:
        raw = _read_header(member, encoding, sep)
        header = standard_names(raw, renames)
        unique = [str(i) for i in range(len(raw))]
        source = {name: unique[header.index(name)] for name in columns if name in header}
        absent = [name for name in required if name not in header] or None

        def batch(row_ids: pa.Array, surplus: pa.Array, cells: Mapping[str, pa.Array]) -> pa.RecordBatch:
            return rows_of(entry, absent, None, row_ids, surplus, cells)

        yield batch(pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), {})
        if not raw:
            return
        # With no wanted column at all the first one is read, for the number of rows.
        wanted = list(dict.fromkeys(source.values())) or unique[:1]
        for numbers, surplus, cells in _read_table(member, unique, wanted, encoding, sep, missing):
            by_source = dict(zip(wanted, cells))
            yield batch(pa.array(numbers, pa.int64()), surplus, {name: by_source[key] for name, key in source.items()})

    members = spread_members(entries, ["origem_zip", "nome_arquivo", "archive_mtime", "entry_mtime"],
                             task_bytes, max_tasks)
    return members.mapInArrow(lambda batches: _each_member(batches, read, failed), rows_schema(columns))


def data_rows(rows: DataFrame) -> DataFrame:
    """Rows of an :func:`archive_rows` result without the one that stands for the member itself."""
    return rows.filter(F.col("row_id").isNotNull())


def member_rows(rows: DataFrame) -> DataFrame:
    """The one row per member of an :func:`archive_rows` result."""
    return rows.filter(F.col("row_id").isNull() & F.col("problem").isNull())


def unreadable_members(rows: DataFrame) -> DataFrame:
    """Rows of an :func:`archive_rows` result that tell why a member could not be read, in ``problem``."""
    return rows.filter(F.col("problem").isNotNull())


def member_contents(entries: DataFrame, task_bytes: int = TASK_BYTES, max_tasks: int = MAX_TASKS,
                    chunk_bytes: int = CONTENT_CHUNK) -> DataFrame:
    """Raw bytes of the members under their ingest names, in numbered chunks.

    A member that cannot be read to its end gives a row without ``chunk_no`` that has its ``problem``; its chunks are not
    to be used.
    """
    names = ("arquivo_ingestao", "origem_zip", "nome_arquivo", "entry_mtime")

    def read(entry: dict, member) -> Iterator[pa.RecordBatch]:
        chunk_no = 0
        while (content := member.read(chunk_bytes)) or chunk_no == 0:
            yield chunk(entry, chunk_no, content, None)
            chunk_no += 1
            if not content:
                break

    def chunk(entry: dict, chunk_no: int | None, content: bytes | None, problem: str | None) -> pa.RecordBatch:
        row = {name: entry[name] for name in names} | {"chunk_no": chunk_no, "content": content, "problem": problem}
        return pa.RecordBatch.from_pylist([row], schema=CONTENT_SCHEMA)

    def failed(entry: dict, problem: str) -> pa.RecordBatch:
        return chunk(entry, None, None, problem)

    members = spread_members(entries, names, task_bytes, max_tasks)
    return members.mapInArrow(lambda batches: _each_member(batches, read, failed),
                              "arquivo_ingestao STRING, origem_zip STRING, nome_arquivo STRING, "
                              "entry_mtime TIMESTAMP_NTZ, chunk_no BIGINT, content BINARY, problem STRING")


CONTENT_SCHEMA = pa.schema([("arquivo_ingestao", pa.string()), ("origem_zip", pa.string()),
                            ("nome_arquivo", pa.string()), ("entry_mtime", pa.timestamp("us")),
                            ("chunk_no", pa.int64()), ("content", pa.binary()), ("problem", pa.string())])
ENTRY_SCHEMA = pa.schema([("path", pa.string()), ("arquivo", pa.string()), ("archive_mtime", pa.timestamp("us", tz="UTC")),
                          ("entry_no", pa.int64()), ("nome_arquivo", pa.string()), ("entry_mtime", pa.timestamp("us")),
                          ("tamanho_bytes", pa.int64()), ("bytes_before", pa.int64()), ("problem", pa.string())])
