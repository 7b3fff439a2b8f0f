"""Delimited members too large for one task.

A member is one compressed stream, so one task has to inflate it. That task cuts the text into chunks of a fixed size, which
it writes into the shared folder, and goes on; it never parses. Whether a line end within a chunk ends a row depends on the
text before: it may be part of a quoted cell. So each chunk is looked through as if it began in each state that a row can
be in, which tells where the first row ends, how many rows begin in it, and the state it ends in. Going along a member's
chunks then settles the state that each really begins in. From there on chunks are parsed side by side. A row belongs to
the chunk that it begins in; what it has in the chunks after is read from these.
"""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.joins import settle
from sluice.operators.quality import standard_names
from sluice.sources.archives import (CSV_BLOCK, MAX_TASKS, TASK_BYTES, UNREADABLE, _each_member, _read_header, _read_table,
                                     archive_rows, dealt, open_path, row_batches, rows_schema, spread_members)

#: Members larger than this are split; no row of a smaller one is longer than the reader's block.
SPLIT_BYTES = CSV_BLOCK
CHUNK_BYTES = 16 << 20

#: States between two bytes: at the start of a row, at the start of another cell, in a plain cell or after a closing quote,
#: in a quoted cell, after a quote in a quoted cell that may close it or be the first of two.
ROW, CELL, PLAIN, QUOTED, QUOTE = range(5)

MEMBER = "path string, entry_no bigint, origem_zip string, nome_arquivo string, archive_mtime timestamp, entry_mtime timestamp_ntz"
CHUNK = (f"{MEMBER}, header array<string>, chunk_no bigint, chunk string, size bigint, ends array<int>, firsts array<bigint>, "
         "counts array<bigint>, problem string")
UNIT = (f"{MEMBER}, header array<string>, chunk_no bigint, base bigint, pieces array<struct<chunk:string,start:bigint,end:bigint>>, "
        "problem string")


@dataclass(frozen=True)
class Dialect:
    """How rows and cells end; the same rules as the reader's: a quote counts at the start of a cell only."""

    sep: bytes

    def patterns(self) -> tuple[re.Pattern, ...]:
        stop = b"[^" + re.escape(self.sep) + rb"\r\n]*+"
        cell = rb'(?:"(?:[^"]++|"")*+"' + stop + rb"|(?!\")" + stop + rb")"
        cells = rb"(?:" + cell + re.escape(self.sep) + rb")*+"
        return tuple(map(re.compile, (cells + cell + rb"[\r\n]", cells, rb'(?:[^"]++|"")*+', stop)))


class Lines:
    """Where rows end in a chunk, from any state."""

    def __init__(self, dialect: Dialect):
        self.row, self.cells, self.quoted, self.plain = dialect.patterns()

    def rest(self, text: bytes, at: int, state: int) -> int:
        """The state at the end of a text that has no more row ends, from the start of a row or cell."""
        start = self.cells.match(text, at).end()
        if start == len(text):
            return state if start == at else CELL
        if text[start:start + 1] != b'"':
            return PLAIN
        close = self.quoted.match(text, start + 1).end()
        return QUOTED if close == len(text) else QUOTE if close + 1 == len(text) else PLAIN

    def first(self, text: bytes, state: int) -> tuple[int, int]:
        """Where the row that is open at the start ends, and the state there; -1 and the last state if it does not end."""
        at, size = 0, len(text)
        if state == ROW or not size:
            return (0, ROW) if state == ROW else (-1, state)
        if state == QUOTE:
            state, at = (QUOTED, 1) if text[:1] == b'"' else (PLAIN, 0)
        if state == QUOTED:
            at = self.quoted.match(text, at).end()
            if at + 1 >= size:
                return -1, QUOTED if at == size else QUOTE
            at, state = at + 1, PLAIN
        if state == PLAIN:
            at = self.plain.match(text, at).end()
            if at == size:
                return -1, PLAIN
            if text[at:at + 1] in (b"\r", b"\n"):
                return at + 1, ROW
            at += 1
        row = self.row.match(text, at)
        return (row.end(), ROW) if row else (-1, self.rest(text, at, CELL))

    def rows(self, text: bytes, at: int) -> tuple[int, int]:
        """Rows that begin from a place on, empty lines left out, and the state at the end."""
        count = 0
        while row := self.row.match(text, at):
            count += row.end() - at > 1
            at = row.end()
        return count + (at < len(text)), self.rest(text, at, ROW)

    def scanned(self, text: bytes) -> tuple[list[int], list[int], list[int]]:
        """For each state at the start: the state at the end, where the open row ends, and the rows that begin."""
        firsts, states = zip(*(self.first(text, state) for state in range(5)))
        counted = {at: self.rows(text, at) for at in {*firsts} - {-1}}
        ends = [state if at == -1 else counted[at][1] for at, state in zip(firsts, states)]
        return ends, list(firsts), [0 if at == -1 else counted[at][0] for at in firsts]


def write_chunks(entries: DataFrame, folder: str, sep: str = ";", encoding: str = "latin1",
                 chunk_bytes: int = CHUNK_BYTES, max_tasks: int = MAX_TASKS) -> DataFrame:
    """Inflate each member once, into chunks below ``folder``; a row per chunk, with what was found in it.

    A chunk is part of the result only if a row names it; what lost attempts leave is never read. A member that cannot be
    read to its end gives a row with its ``problem``.
    """
    names = [field.split()[0] for field in CHUNK.split(", ")]

    def row(entry: dict, **values) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{name: entry.get(name) for name in names} | values], schema=CHUNK_SCHEMA)

    def read(entry: dict, member) -> Iterator[pa.RecordBatch]:
        header, lines = _read_header(member, encoding, sep), Lines(Dialect(sep.encode(encoding)))
        store, place = open_path(folder)
        number = 0
        while (text := member.read(chunk_bytes)) or not number:
            name = f"{uuid.uuid4().hex}.chunk"
            with store.open_output_stream(f"{place}/{name}") as out:
                out.write(text)
            ends, firsts, counts = lines.scanned(text)
            yield row(entry, header=header, chunk_no=number, chunk=name, size=len(text), ends=ends, firsts=firsts, counts=counts)
            number += 1
            if not text:
                break

    def failed(entry: dict, problem: str) -> pa.RecordBatch:
        return row(entry, problem=problem)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = open_path(folder)
        store.create_dir(place)
        return _each_member(batches, read, failed)

    members = spread_members(entries.withColumn("path_", F.col("path")), ["origem_zip", "nome_arquivo", "archive_mtime", "entry_mtime", "path_"], 1, max_tasks)
    members = members.withColumn("members", F.transform("members", lambda m: m.withField("path", m["path_"]).dropFields("path_")))
    return settle(members.mapInArrow(run, CHUNK))


def units(key: tuple[pa.Scalar, ...], chunks: pa.Table) -> pa.Table:
    """The pieces of text to be parsed together, with the number of their first row: one small row per chunk of a member."""
    state, base, out = ROW, 0, []
    for chunk in sorted((c for c in chunks.to_pylist() if c["problem"] is None), key=lambda c: c["chunk_no"]):
        first = chunk["firsts"][state]
        if state != ROW and out:
            out[-1]["pieces"].append({"chunk": chunk["chunk"], "start": 0, "end": chunk["size"] if first == -1 else first})
        if first != -1 and (chunk["counts"][state] or not chunk["chunk_no"]):
            out.append({name: chunk[name] for name in UNIT_SCHEMA.names if name in chunk}
                       | {"base": base, "pieces": [{"chunk": chunk["chunk"], "start": first, "end": chunk["size"]}]})
            base += chunk["counts"][state]
        state = chunk["ends"][state]
    out += [{name: c.get(name) for name in UNIT_SCHEMA.names} for c in chunks.to_pylist() if c["problem"] is not None]
    return pa.Table.from_pylist(out, schema=UNIT_SCHEMA)


class Pieces(io.RawIOBase):
    """Parts of files, one after the other."""

    def __init__(self, store, place: str, pieces: Sequence[Mapping]):
        self.store, self.place, self.pieces = store, place, [p for p in pieces if p["end"] > p["start"]]
        self.file, self.left = None, 0

    def readable(self) -> bool:
        return True

    def read(self, size: int = -1) -> bytes:
        if not self.left:
            if self.file is not None:
                self.file.close()
            if not self.pieces:
                self.file = None
                return b""
            piece = self.pieces.pop(0)
            self.file, self.left = self.store.open_input_file(f"{self.place}/{piece['chunk']}"), piece["end"] - piece["start"]
            self.file.seek(piece["start"])
        text = self.file.read(self.left if size < 0 else min(size, self.left))
        self.left -= len(text)
        return text


def split_rows(entries: DataFrame, columns: Sequence[str], folder: str, renames: Mapping[str, str] | None = None,
               required: Sequence[str] = (), sep: str = ";", encoding: str = "latin1", missing: Sequence[str] = ("",),
               chunk_bytes: int = CHUNK_BYTES, max_tasks: int = MAX_TASKS) -> DataFrame:
    """As :func:`sluice.sources.archives.archive_rows`, with the text of each member parsed by as many tasks as it has chunks.

    Rows and their numbers are the same. A row may be as long as an Arrow cell can be. Chunks go to ``folder``, which
    executors can reach and which may be deleted once the rows have been read.
    """
    columns, renames, required, missing = list(columns), dict(renames or {}), list(required), list(missing)
    chunks = write_chunks(entries, folder, sep, encoding, chunk_bytes, max_tasks)
    parts = settle(chunks.groupBy("path", "entry_no").applyInArrow(units, UNIT))
    batch_of = row_batches(columns)

    def parse(unit: dict, store, place: str) -> Iterator[pa.RecordBatch]:
        raw, none = unit["header"] or [], pa.nulls(1, pa.int64())
        header = standard_names(raw, renames)
        unique = [str(i) for i in range(len(raw))]
        source = {name: unique[header.index(name)] for name in columns if name in header}
        absent = [name for name in required if name not in header] or None
        if unit["chunk_no"] == 0:
            yield batch_of(unit, absent, None, none, none, {})
        wanted = list(dict.fromkeys(source.values())) or unique[:1]
        # The reader takes a block at a time, which has to hold the longest row.
        size = sum(piece["end"] - piece["start"] for piece in unit["pieces"])
        if raw and size:
            text = Pieces(store, place, unit["pieces"])
            for numbers, surplus, cells in _read_table(text, unique, wanted, encoding, sep, missing, max(CSV_BLOCK, size + 1024)):
                by_source = dict(zip(wanted, cells))
                yield batch_of(unit, absent, None, pa.array(numbers + unit["base"], pa.int64()), surplus,
                               {name: by_source[key] for name, key in source.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = open_path(folder)
        for batch in batches:
            for unit in batch.to_pylist():
                problem = unit["problem"]
                if problem is None:
                    try:
                        yield from parse(unit, store, place)
                    except UNREADABLE as error:
                        problem = str(error)
                if problem is not None:
                    yield batch_of(unit, None, problem, pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), {})

    size = F.aggregate("pieces", F.lit(0).cast("bigint"), lambda total, piece: total + piece["end"] - piece["start"])
    return dealt(parts, ["path", "entry_no", "chunk_no"], size, max_tasks).mapInArrow(run, rows_schema(columns))


def all_rows(entries: DataFrame, columns: Sequence[str], folder: str, renames: Mapping[str, str] | None = None,
             required: Sequence[str] = (), sep: str = ";", encoding: str = "latin1", missing: Sequence[str] = ("",),
             task_bytes: int = TASK_BYTES, max_tasks: int = MAX_TASKS, split_bytes: int = SPLIT_BYTES,
             chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of all members: large ones split, the others as :func:`sluice.sources.archives.archive_rows` reads them."""
    large = F.col("tamanho_bytes") > split_bytes
    how = {"renames": renames, "required": required, "sep": sep, "encoding": encoding, "missing": missing, "max_tasks": max_tasks}
    small = archive_rows(entries.where(~large), columns, task_bytes=task_bytes, **how)
    if entries.where(large).isEmpty():
        return small
    return small.unionByName(split_rows(entries.where(large), columns, folder, chunk_bytes=chunk_bytes, **how))


def _schema(ddl: Mapping[str, pa.DataType]) -> pa.Schema:
    member = [("path", pa.string()), ("entry_no", pa.int64()), ("origem_zip", pa.string()), ("nome_arquivo", pa.string()),
              ("archive_mtime", pa.timestamp("us", tz="UTC")), ("entry_mtime", pa.timestamp("us")),
              ("header", pa.list_(pa.string())), ("chunk_no", pa.int64())]
    return pa.schema([*member, *ddl.items(), ("problem", pa.string())])


CHUNK_SCHEMA = _schema({"chunk": pa.string(), "size": pa.int64(), "ends": pa.list_(pa.int32()),
                        "firsts": pa.list_(pa.int64()), "counts": pa.list_(pa.int64())})
UNIT_SCHEMA = _schema({"base": pa.int64(), "pieces": pa.list_(pa.struct(
    [("chunk", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))})
