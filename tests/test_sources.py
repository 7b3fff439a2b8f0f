from __future__ import annotations

import io
import subprocess
import sys
import zipfile
from datetime import datetime

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import tuples, write_zip
from sluice.layouts import MISSING_TEXTS
from sluice.sources import archives, portal
from sluice.sources.landing import landing_manifest


def page(spark, html):
    return spark.createDataFrame([(1, html)], "page_id BIGINT, html STRING")


@pytest.mark.parametrize("anchor, expected", [
    ('<a href="x.zip">x</a>', ["x.zip"]),
    ("<A class=b HREF = 'x.zip'>x</A>", ["x.zip"]),
    ("<a href=x.zip>x</a>", ["x.zip"]),
    ('<a\nid="1"\nhref="x.zip"\n>x</a>', ["x.zip"]),
    ('<a href="a&amp;b.zip">x</a>', ["a&b.zip"]),
    ('<a name="x.zip">x</a>', []),
    ('<a href="x.txt">x</a>', []),
    ('<a href="">x</a>', []),
    ('<abbr href="x.zip">x</abbr>', []),
    ('<!-- <a href="x.zip">x</a> --><a href="y.zip"></a>', ["y.zip"]),
    ('<script>var a = \'<a href="x.zip">\';</script>', []),
    ('<a href="x.zip"></a><a href="y.zip"></a><a href="x.zip"></a>', ["x.zip", "y.zip", "x.zip"]),
])
def test_links(spark, anchor, expected):
    found = portal.portal_links(page(spark, anchor), F.lit("http://h/")).orderBy("position").collect()
    assert [row.arquivo for row in found] == expected
    assert [row.url for row in found] == [f"http://h/{name}" for name in expected]


def test_manifest_lists_only_archives(spark, landing):
    write_zip(landing / "a.zip", [("a.csv", "x\n")], mtime=1_741_000_000)
    (landing / "x.txt").write_text("x")
    found = landing_manifest(spark, str(landing)).select("arquivo", F.unix_seconds("data_modificacao").alias("s"))
    assert tuples(found, "arquivo", "s") == [("a.zip", 1_741_000_000)]


def test_manifest_of_empty_and_missing_folder_keeps_columns(spark, landing, tmp_path):
    for folder in (landing, tmp_path / "missing"):
        found = landing_manifest(spark, str(folder))
        assert found.count() == 0
        assert found.columns == ["arquivo", "data_modificacao", "path", "length"]


def entries_of(spark, folder):
    return archives.archive_entries(landing_manifest(spark, str(folder)))


def test_manifest_plan_reads_no_content(spark, landing):
    write_zip(landing / "a.zip", [("a.csv", "x\n")])
    plan = landing_manifest(spark, str(landing))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_entries(spark, landing):
    write_zip(landing / "a b.zip", [("d/", ""), ("d/cad_fi.csv", "abc"), ("x.csv", "")])
    write_zip(landing / "c.zip", [("x.csv", "1")], when=(2024, 1, 1, 0, 0, 0))
    found = entries_of(spark, landing)
    moment = datetime(2025, 3, 5, 9, 10, 12)
    assert tuples(found, "origem_zip", "nome_arquivo", "entry_mtime", "tamanho_bytes", "arquivo_ingestao") == sorted([
        ("a b", "d/", moment, 0, "d_20250305091012"),
        ("a b", "d/cad_fi.csv", moment, 3, "cad_fi_20250305091012.csv"),
        ("a b", "x.csv", moment, 0, "x_20250305091012.csv"),
        ("c", "x.csv", datetime(2024, 1, 1), 1, "x_20240101000000.csv")], key=repr)


def rows_of(spark, folder, columns, **options):
    return archives.archive_rows(entries_of(spark, folder), columns, **options)


def test_rows_keep_quoted_text_and_fill_short_rows(spark, landing):
    text = ' A ;B;C\r\n1;"x;y\nz";é\r\n\r\n2;NA;"q""q"\r\n3;short\r\n4;x;y;long\r\n5;;z\r\n'
    write_zip(landing / "a.zip", [("m.csv", text)])
    rows = archives.data_rows(rows_of(spark, landing, ["C", "A", "B", "D"], required=["A", "D"], missing=("", "NA")))
    assert tuples(rows, "row_id", "A", "B", "C", "D", "surplus", "absent") == [
        (0, "1", "x;y\nz", "é", None, None, ["D"]), (1, "2", None, 'q"q', None, None, ["D"]),
        (2, "3", "short", None, None, None, ["D"]), (3, "4", "x", "y", None, 1, ["D"]),
        (4, "5", None, "z", None, None, ["D"])]


def test_members_without_rows_are_not_lost(spark, landing):
    write_zip(landing / "a.zip", [("empty.csv", ""), ("head.csv", "A;B\n"), ("blank.csv", "A;B\n\n\n"), ("d/", "")])
    rows = rows_of(spark, landing, ["A"], required=["A", "B"])
    assert tuples(rows, "arquivo", "row_id", "absent") == [
        ("blank.csv", None, None), ("empty.csv", None, ["A", "B"]), ("head.csv", None, None)]


def test_members_of_one_name_are_told_apart(spark, landing):
    with pytest.warns(UserWarning):
        write_zip(landing / "a.zip", [("m.csv", "A\n1\n"), ("m.csv", "A\n2\n")])
    write_zip(landing / "b.zip", [("m.csv", "A\n3\n")])
    rows = archives.data_rows(rows_of(spark, landing, ["A"]))
    assert tuples(rows, "origem_zip", "A") == [("a", "1"), ("a", "2"), ("b", "3")]


def test_small_stretches_give_the_same_rows(spark, landing):
    members = [(f"m{i}.csv", "A;B\n" + "".join(f"{i};{j}\n" for j in range(i * 20))) for i in range(12)]
    write_zip(landing / "a.zip", members)
    whole = tuples(rows_of(spark, landing, ["A", "B"]), "arquivo", "row_id", "A", "B")
    spread = rows_of(spark, landing, ["A", "B"], task_bytes=500)
    assert spread.rdd.getNumPartitions() > 4
    assert tuples(spread, "arquivo", "row_id", "A", "B") == whole


@pytest.mark.parametrize("regular", [lambda i: i % 7, lambda i: i > 3000, lambda i: i < 3000, lambda i: False,
                                     lambda i: True, lambda i: i // 500 % 2], ids=str)
def test_irregular_rows_keep_their_numbers_in_every_block(monkeypatch, regular):
    text = "".join(f"{i};x\n" if regular(i) else f"{i}\n" if i % 2 else f"{i};x;y\n" for i in range(5000))
    monkeypatch.setattr(archives, "CSV_BLOCK", 2000)
    found, largest = {}, 0
    for numbers, surplus, cells in read_text(text, ["0", "1"], ["0"], [""]):
        found.update(zip(numbers.tolist(), zip(cells[0].to_pylist(), surplus.to_pylist())))
        largest = max(largest, len(numbers))
    assert found == {i: (str(i), None if regular(i) or i % 2 else 1) for i in range(5000)}
    assert largest < 1000


def read_text(text, names, wanted, missing):
    return archives._read_table(io.BufferedReader(io.BytesIO(text.encode("latin-1"))), names, wanted, "latin1", ";",
                                missing)


@pytest.mark.parametrize("path", ["/a b/x.zip", "file:/a b/x.zip", "file:///a b/x.zip"])
def test_local_paths(path):
    assert archives.open_path(path)[1] == "/a b/x.zip"


def test_task_functions_travel_with_the_job(tmp_path):
    """Executors need not have the package."""
    (tmp_path / "task").write_bytes(cloudpickle.dumps(archives._list_entries))
    code = "import pickle, sys; pickle.load(open('task', 'rb')); assert 'sluice' not in sys.modules"
    subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, check=True)


def test_one_column(spark, landing):
    write_zip(landing / "a.zip", [("m.csv", "A\n1\n\n2\n3;4\n")])
    rows = archives.data_rows(rows_of(spark, landing, ["A"]))
    assert tuples(rows, "row_id", "A", "surplus") == [(0, "1", None), (1, "2", None), (2, "3", 1)]


def test_every_large_member_has_a_task_of_its_own(spark, landing):
    for i in range(12):
        write_zip(landing / f"a{i}.zip", [("large.csv", "A\n" + "1\n" * 500), ("small.csv", "A\n1\n")])
    spread = archives.spread_members(entries_of(spark, landing), ["nome_arquivo"], task_bytes=900)
    counts = spread.select(F.spark_partition_id().alias("p")).groupBy("p").count()
    assert tuples(counts, "p", "count") == sorted([(i, 1) for i in range(24)], key=repr)


CELL = st.text(alphabet='ab;"\n é0.', max_size=6)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(CELL, CELL, CELL), min_size=1, max_size=8))
def test_member_reading_agrees_with_pandas(rows):
    """All cells quoted, so that both readers see the same rows."""
    quoted = "\n".join(";".join('"' + cell.replace('"', '""') + '"' for cell in row) for row in rows) + "\n"
    expected = pd.read_csv(io.BytesIO(quoted.encode("latin-1")), sep=";", encoding="latin1", dtype=str,
                           header=None).astype(object)
    expected = expected.where(expected.notna(), None).values.tolist()
    ours = {}
    for numbers, _, cells in read_text(quoted, ["0", "1", "2"], ["0", "1", "2"], MISSING_TEXTS):
        ours.update(zip(numbers.tolist(), zip(*(cell.to_pylist() for cell in cells))))
    assert [list(ours[i]) for i in sorted(ours)] == expected


def test_contents_come_whole_in_chunks(spark, landing, monkeypatch):
    body = bytes(range(256)) * 40_000
    with zipfile.ZipFile(landing / "a.zip", "w") as archive:
        archive.writestr(zipfile.ZipInfo("m.bin", (2025, 3, 5, 9, 10, 12)), body)
        archive.writestr(zipfile.ZipInfo("none.bin", (2025, 3, 5, 9, 10, 12)), b"")
    found = archives.member_contents(entries_of(spark, landing)).orderBy("nome_arquivo", "chunk_no").collect()
    assert b"".join(bytes(row.content) for row in found) == body
    assert [(row.nome_arquivo, row.chunk_no) for row in found] == [("m.bin", 0), ("m.bin", 1), ("m.bin", 2),
                                                                   ("none.bin", 0)]
    assert {row.arquivo_ingestao for row in found} == {"m_20250305091012.bin", "none_20250305091012.bin"}


def test_many_stretches_in_few_tasks(spark, landing):
    """The same rows as with a task for each stretch, dealt out evenly."""
    for i in range(4):
        write_zip(landing / f"{i}.zip", [(f"{i}_{k}.csv", f"A;B\n{i};{k}\n") for k in range(250)])
    entries = entries_of(spark, landing)
    few = archives.spread_members(entries, ["nome_arquivo"], task_bytes=8, max_tasks=10)
    assert few.count() == 1000 and few.rdd.getNumPartitions() == 10
    sizes = few.groupBy(F.spark_partition_id()).count().select("count").collect()
    assert max(r[0] for r in sizes) <= 2 * 1000 / 10
    rows = [tuples(archives.archive_rows(entries, ["A", "B"], task_bytes=8, max_tasks=n), "arquivo", "A", "B")
            for n in (10, 10_000)]
    assert rows[0] == rows[1]


def test_many_small_members_share_tasks(spark, landing, monkeypatch):
    """Tasks follow the bytes beyond a number of tasks; the rows are the same."""
    for i in range(3):
        write_zip(landing / f"{i}.zip", [(f"{i}_{k}.csv", f"A;B\n{i};{k}\n") for k in range(100)])
    entries = entries_of(spark, landing)
    spread = archives.spread_members(entries, ["nome_arquivo"], task_bytes=8)
    enough = max(archives.MANY_TASKS, 4 * spark.sparkContext.defaultParallelism)
    assert spread.count() == 300 and spread.rdd.getNumPartitions() == enough < 300
    found = tuples(archives.archive_rows(entries, ["A", "B"], task_bytes=8), "arquivo", "A", "B")
    monkeypatch.setattr(archives, "WORTH_BYTES", 8)
    assert archives.spread_members(entries, ["nome_arquivo"], task_bytes=8).rdd.getNumPartitions() == 300
    assert found == tuples(archives.archive_rows(entries, ["A", "B"], task_bytes=8), "arquivo", "A", "B")
