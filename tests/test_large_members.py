"""Members in chunks against the same members read whole."""

from __future__ import annotations

import io

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import tuples, write_zip
from sluice.sources import archives, large_members
from sluice.sources.landing import landing_manifest

NAMES = ["0", "1"]


def read(text: bytes, base: int = 0, block=None) -> dict:
    found = {}
    for numbers, surplus, cells in archives._read_table(io.BufferedReader(io.BytesIO(text)), NAMES, NAMES, "latin1", ";", [""], block):
        found.update({int(n) + base: values for n, *values in zip(numbers, surplus.to_pylist(), *(c.to_pylist() for c in cells))})
    return found


def in_chunks(text: bytes, size: int) -> dict:
    """What the units of a text cut into chunks hold, each read by itself."""
    lines, chunks = large_members.Lines(large_members.Dialect(b";")), []
    parts = [text[i:i + size] for i in range(0, len(text), size)] or [b""]
    for number, part in enumerate(parts):
        ends, firsts, counts = lines.scanned(part)
        chunks.append({"chunk_no": number, "chunk": str(number), "size": len(part), "ends": ends, "firsts": firsts, "counts": counts})
    table = pa.Table.from_pylist([{n: c.get(n) for n in large_members.CHUNK_SCHEMA.names} for c in chunks], schema=large_members.CHUNK_SCHEMA)
    found = {}
    for unit in large_members.units((), table).to_pylist():
        body = b"".join(parts[int(p["chunk"])][p["start"]:p["end"]] for p in unit["pieces"])
        rows = read(body, unit["base"]) if body else {}
        assert not rows.keys() & found.keys()
        found |= rows
    return found


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet='ab;;"""\n\n\ré', max_size=60), st.integers(1, 9))
def test_any_cut_gives_the_same_rows(text, size):
    text = text.encode("latin-1")
    try:
        whole = read(text)
    except pa.ArrowInvalid:
        return  # a text whose quotes do not close is refused as a whole
    assert in_chunks(text, size) == whole


def test_rows_longer_than_many_chunks():
    text = b'1;x\n"' + b'long ""; \r\n' * 2000 + b'";y\n\n\r\n3;z\n' + b"4;" + b"q" * 5000
    assert in_chunks(text, 100) == read(text) and sorted(read(text)) == [0, 1, 2, 3]


@pytest.mark.parametrize("chunk_bytes", [11, 4096])
def test_split_members_give_the_rows_of_whole_ones(spark, landing, tmp_path, chunk_bytes):
    quoted = "".join(f'{i};"cell ""{i}""\r\nof two lines; é";{i % 7}\r\n' for i in range(60))
    write_zip(landing / "a.zip", [
        ("quoted.csv", " A ;B;C\r\n" + quoted), ("short.csv", "A;B\n1\n2;3;4\n\n5;6"), ("empty.csv", ""), ("head.csv", "A;B\n"),
        ("blank.csv", "\n\nA;B\n\n\n"), ("other.csv", "C;A\n" + "x;1\n" * 40)])
    entries = archives.archive_entries(landing_manifest(spark, str(landing)))
    how = {"required": ["A", "B"], "renames": {"C": "D"}}
    whole = archives.archive_rows(entries, ["A", "B", "D"], **how)
    split = large_members.all_rows(entries, ["A", "B", "D"], str(tmp_path / "chunks"), split_bytes=-1, chunk_bytes=chunk_bytes, **how)
    assert split.columns == whole.columns and tuples(split, *split.columns) == tuples(whole, *whole.columns)
    some = large_members.all_rows(entries, ["A", "B", "D"], str(tmp_path / "some"), split_bytes=100, chunk_bytes=chunk_bytes, **how)
    assert tuples(some, *some.columns) == tuples(whole, *whole.columns)


def test_no_task_has_more_than_a_chunk(spark, landing, tmp_path):
    write_zip(landing / "a.zip", [("m.csv", "A;B\n" + "12345678;1\n" * 4000)])
    entries = archives.archive_entries(landing_manifest(spark, str(landing)))
    rows = archives.data_rows(large_members.split_rows(entries, ["A"], str(tmp_path / "chunks"), chunk_bytes=2048))
    counts = [r[0] for r in rows.groupBy(large_members.F.spark_partition_id()).count().select("count").collect()]
    assert sum(counts) == 4000 and max(counts) <= 2048 / 11 + 2


def test_a_member_that_breaks_off_is_told(spark, landing, tmp_path):
    write_zip(landing / "a.zip", [("m.csv", "A;B\n" + "".join(f"{i};{i * i}\n" for i in range(5000)))])
    content = bytearray((landing / "a.zip").read_bytes())
    content[len(content) // 2] ^= 0xFF
    (landing / "a.zip").write_bytes(content)
    entries = archives.archive_entries(landing_manifest(spark, str(landing)))
    rows = large_members.split_rows(entries, ["A"], str(tmp_path / "chunks"), chunk_bytes=1000)
    assert archives.unreadable_members(rows).count() == 1


def test_many_small_chunks_share_tasks(spark, landing, tmp_path):
    write_zip(landing / "a.zip", [("m.csv", "A;B\n" + "12345678;1\n" * 4000)])
    entries = archives.archive_entries(landing_manifest(spark, str(landing)))
    rows = large_members.split_rows(entries, ["A"], str(tmp_path / "chunks"), chunk_bytes=200)
    assert rows.rdd.getNumPartitions() == max(archives.MANY_TASKS, 4 * spark.sparkContext.defaultParallelism) < 220
    assert sorted(r[0] for r in archives.data_rows(rows).select("row_id").collect()) == list(range(4000))
