from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import tuples, write_zip
from sluice.operators.files import file_versions
from sluice.operators.manifest import exclude_names, ingest_plan, manifest_diff
from sluice.plans.control import destinations, load_control, run_control
from sluice.plans.discovery import fetch_plan
from sluice.sources.landing import landing_manifest

EARLY, LATE = (2025, 3, 5, 9, 10, 12), (2025, 4, 5, 9, 10, 12)


def load(spark, landing, tables, exclude=(), **how):
    return load_control(spark, landing_manifest(spark, str(landing)), tables, exclude, **how)


def recorded(spark, tables):
    return tuples(spark.table(tables.control), "origem_zip", "nome_arquivo", "arquivo_ingestao", "tamanho_bytes", "fonte",
                  "situacao_arquivo")


def test_members_are_recorded_and_landed_once(spark, landing, control_tables):
    write_zip(landing / "a.zip", [("cad_fi.csv", "abc"), ("d/", "")], EARLY)
    for _ in range(2):
        load(spark, landing, control_tables)
    assert recorded(spark, control_tables) == [
        ("a", "cad_fi.csv", "cad_fi_20250305091012.csv", 3, None, None), ("a", "d/", "d_20250305091012", 0, None, None)]
    assert tuples(spark.table(control_tables.members), "arquivo_ingestao", "content") == [
        ("cad_fi_20250305091012.csv", bytearray(b"abc"))]


def test_a_new_version_of_a_member_is_a_new_row(spark, landing, control_tables):
    for when, landed in ((EARLY, 1_741_000_000), (LATE, 1_744_000_000)):
        write_zip(landing / "a.zip", [("x.csv", "abc"), ("y.csv", "abc")], when, landed)
        load(spark, landing, control_tables)
    write_zip(landing / "b.zip", [("z.csv", "abc")], LATE)
    load(spark, landing, control_tables)
    assert tuples(file_versions(spark.table(control_tables.control)), "nome_arquivo", "qtd_versoes") == [
        ("x.csv", 2), ("y.csv", 2), ("z.csv", 1)]


def test_members_of_one_name_in_two_archives(spark, landing, control_tables):
    """They are told apart by time: the one already recorded is not landed again with the other."""
    write_zip(landing / "a.zip", [("x.csv", "early")], EARLY)
    load(spark, landing, control_tables)
    write_zip(landing / "b.zip", [("x.csv", "late")], LATE)
    load(spark, landing, control_tables)
    assert tuples(spark.table(control_tables.members), "origem_zip", "content") == [
        ("a", bytearray(b"early")), ("b", bytearray(b"late"))]


@pytest.mark.parametrize("when", [1, 2, 3])
def test_a_run_that_broke_off_is_done_whole_by_the_next(spark, landing, control_tables, monkeypatch, when):
    """It breaks off after the first of three chunks, within the control rows, within the archives."""
    from sluice.plans import control

    write_zip(landing / "a.zip", [("x.csv", "abcdefghi"), ("y.csv", "abc")], EARLY)
    real, calls = control.append_part, []

    def breaks(df, *rest):
        calls.append(rest)
        real(df.limit(1) if len(calls) == when else df, *rest)
        if len(calls) == when:
            raise RuntimeError("lost")

    monkeypatch.setattr(control, "append_part", breaks)
    with pytest.raises(RuntimeError):
        load(spark, landing, control_tables, chunk_bytes=3)
    monkeypatch.undo()
    assert spark.table(control_tables.members).count() == spark.table(control_tables.control).count() == 0
    assert load(spark, landing, control_tables, chunk_bytes=3)
    assert tuples(spark.table(control_tables.members).where("nome_arquivo = 'x.csv'"), "chunk_no", "content") == [
        (0, bytearray(b"abc")), (1, bytearray(b"def")), (2, bytearray(b"ghi"))]
    assert spark.table(control_tables.control).count() == 2
    assert not load(spark, landing, control_tables)


def test_unreadable_members_are_recorded_with_their_state(spark, landing, control_tables):
    write_zip(landing / "a.zip", [("x.csv", "abc" * 50), ("y.csv", "abc")], EARLY)
    content = bytearray((landing / "a.zip").read_bytes())
    content[30 + len("x.csv") + 2] ^= 0xFF
    (landing / "a.zip").write_bytes(bytes(content))
    (landing / "b.zip").write_bytes(b"no archive")
    done = load(spark, landing, control_tables)
    assert (done.archives, done.unreadable, done.members) == (2, 1, 2)
    assert tuples(spark.table(control_tables.control), "nome_arquivo", "situacao_arquivo") == [
        ("x.csv", "member_unreadable"), ("y.csv", None)]
    assert not load(spark, landing, control_tables)


def test_pages_lead_to_members_with_their_destination(spark, landing, control_tables):
    write_zip(landing / "stray.zip", [("s.csv", "abc")], EARLY)
    pages = spark.createDataFrame([(1, '<a href="a.zip">a</a><a href="b.zip">b</a><a href="n.txt">n</a>'),
                                   (2, '<a href="a.zip">again</a>')], "page INT, html STRING")
    asked = []

    def fetch(plan):
        asked.append(tuples(plan, "nome_arquivo", "caminho_completo"))
        write_zip(landing / "a.zip", [("x.csv", "abc")], EARLY)

    plan = destinations(pages, F.lit("h/"), F.concat(F.lit("to/"), F.col("page").cast("string")), order=["page"],
                        exclude=["b"])
    assert run_control(spark, plan, str(landing), control_tables, fetch)
    assert asked == [[("a", "to/2")]]
    assert tuples(spark.table(control_tables.members), "nome_arquivo", "caminho_destino") == [("x.csv", "to/2")]


def test_excluded_archives_are_left_out(spark, landing, control_tables):
    write_zip(landing / "a.zip", [("x.csv", "abc")])
    write_zip(landing / "b.zip", [("y.csv", "abc")])
    load(spark, landing, control_tables, ["b", "absent"])
    assert [row[0] for row in recorded(spark, control_tables)] == ["a"]
    assert exclude_names(spark.table(control_tables.control), []).count() == 1


def test_manifest_diff_cases(spark):
    day = lambda d: None if d is None else datetime(2025, 3, d)
    portal = spark.createDataFrame([("undated.zip", "u", None), ("equal.zip", "u", day(2)), ("later.zip", "u", day(3)),
                                    ("older.zip", "u", day(1)), ("new.zip", "u", day(1)), ("newundated.zip", "u", None)],
                                   "arquivo STRING, url STRING, data_modificacao TIMESTAMP")
    landed = spark.createDataFrame([(f"{name}.zip", day(2)) for name in ("undated", "equal", "later", "older", "gone")],
                                   "arquivo STRING, data_modificacao TIMESTAMP")
    assert tuples(manifest_diff(portal, landed), "arquivo") == [("later.zip",), ("new.zip",), ("newundated.zip",)]
    assert manifest_diff(portal, landed.limit(0)).count() == 6


def test_plan_keeps_the_last_of_equal_names(spark):
    links = spark.createDataFrame([("a.zip", 1, "x/"), ("a.zip", 2, "y/"), ("b.c.zip", 3, "x/"), ("noext", 4, "x/")],
                                  "nome_arquivo STRING, pos INT, folder STRING")
    plan = ingest_plan(links, F.col("folder"), ["pos"])
    assert tuples(plan, "nome_arquivo", "caminho_completo") == [("a", "y/"), ("b.c", "x/"), ("noext", "x/")]


def test_fetch_plan(spark, landing):
    write_zip(landing / "old.zip", [("x", "x")], mtime=1_741_000_000)
    write_zip(landing / "same.zip", [("x", "x")], mtime=1_741_000_000)
    html = '<a href="old.zip">a</a><a href="same.zip">b</a><a href="new.zip">c</a><a href="x.txt">d</a>'
    pages = spark.createDataFrame([(html,)], "html STRING")
    headers = spark.createDataFrame([("h/old.zip", "Wed, 05 Mar 2025 09:10:11 GMT"),
                                     ("h/same.zip", "Mon, 03 Mar 2025 11:06:40 GMT")], "url STRING, last_modified STRING")
    assert tuples(fetch_plan(spark, pages, headers, str(landing), F.lit("h/")), "arquivo", "url") == [
        ("new.zip", "h/new.zip"), ("old.zip", "h/old.zip")]


def test_loads_side_by_side_record_each_member_once(spark, landing, control_tables):
    from sluice.plans import control

    write_zip(landing / "a.zip", [("x.csv", "abcdefghi"), ("y.csv", "abc")], EARLY)
    outer = control.begin_control(spark, control.landing_manifest(spark, str(landing)), control_tables)
    write_zip(landing / "b.zip", [("z.csv", "abc")], EARLY)
    assert load(spark, landing, control_tables, chunk_bytes=3)
    control.complete_control(spark, outer, control_tables, chunk_bytes=3)
    assert spark.table(control_tables.control).count() == 3
    assert spark.table(control_tables.members).count() == 5
    assert spark.table(control_tables.archives).count() == 2
    assert not load(spark, landing, control_tables)
