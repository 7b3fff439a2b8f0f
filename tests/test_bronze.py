from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import NEW, OLD, new_row, old_row, report, tuples, write_zip
from sluice.operators.quality import (Rule, accepted_rows, failure_counts, quarantined_rows, schema_failures,
                                      standardise_columns)
from sluice.operators.tables import append_unseen, create_table
from sluice.plans.bronze import load_bronze
from sluice.sources.archives import data_rows


def load(spark, landing, tables):
    return load_bronze(spark, str(landing), tables)


def failures_of(spark, tables):
    return tuples(spark.table(tables.failures), "arquivo", "row_id", "column_name", "check_name", "failure_case")


def test_header_layouts_meet_in_one_table(spark, landing, bronze_tables):
    write_zip(landing / "a.zip", [("old.csv", report(OLD, old_row(fund="1")))])
    write_zip(landing / "b.zip", [("new.csv", report([f" {NEW[0]} ", *NEW[1:]], new_row(fund="2")))])
    load(spark, landing, bronze_tables)
    assert tuples(spark.table(bronze_tables.bronze), "TP_FUNDO", "CNPJ_FUNDO", "NR_COTST", "ID_SUBCLASSE", "ano", "mes") \
        == [("CLASSES - FIF", "2", 7, "S1", 2025, 3), ("FI", "1", 7, None, 2025, 3)]


def test_a_bad_file_is_rejected_whole_and_the_others_load(spark, landing, bronze_tables):
    write_zip(landing / "a.zip", [("good.csv", report(OLD, old_row(fund="1"), old_row(fund="2", total=""))),
                                  ("text.csv", report(OLD, old_row(fund="3"), old_row(fund="4", holders="abc"))),
                                  ("null.csv", report(OLD, old_row(fund=""), old_row(fund="6"))),
                                  ("lacks.csv", report([c for c in OLD if c != "VL_QUOTA"],
                                                       [v for i, v in enumerate(old_row(fund="7")) if i != 4])),
                                  ("long.csv", report(OLD, old_row(fund="8") + ["x"])),
                                  ("short.csv", report(OLD, old_row(fund="9")[:-1])),
                                  ("empty.csv", ""), ("extra.csv", report(OLD + ["X"], old_row(fund="10") + ["x"]))])
    assert load(spark, landing, bronze_tables)
    assert tuples(spark.table(bronze_tables.bronze), "arquivo", "CNPJ_FUNDO") == [
        ("extra.csv", "10"), ("good.csv", "1"), ("good.csv", "2")]
    assert failures_of(spark, bronze_tables) == sorted([
        *(("empty.csv", None, column, "column_in_dataframe", column) for column in OLD),
        ("lacks.csv", None, "VL_QUOTA", "column_in_dataframe", "VL_QUOTA"),
        ("long.csv", 0, None, "field_count", "1"),
        ("null.csv", 0, "CNPJ_FUNDO", "not_nullable", None),
        ("short.csv", 0, "NR_COTST", "not_nullable", None),
        ("text.csv", 1, "NR_COTST", "dtype(bigint)", "abc")], key=repr)


def test_second_run_adds_nothing(spark, landing, bronze_tables):
    write_zip(landing / "a.zip", [("good.csv", report(OLD, old_row())), ("bad.csv", report(OLD, old_row(holders="x")))])
    assert load(spark, landing, bronze_tables)
    assert not load(spark, landing, bronze_tables)
    assert spark.table(bronze_tables.bronze).count() == 1
    assert len(failures_of(spark, bronze_tables)) == 1


def test_only_the_new_file_is_appended(spark, landing, bronze_tables):
    write_zip(landing / "a.zip", [("a.csv", report(OLD, old_row(fund="1")))])
    load(spark, landing, bronze_tables)
    write_zip(landing / "b.zip", [("b.csv", report(OLD, old_row(fund="2")))])
    load(spark, landing, bronze_tables)
    assert tuples(spark.table(bronze_tables.bronze), "CNPJ_FUNDO") == [("1",), ("2",)]


def test_a_restated_archive_is_a_new_version(spark, landing, bronze_tables):
    write_zip(landing / "a.zip", [("a.csv", report(OLD, old_row(quota="1.0")))], mtime=1_741_000_000)
    load(spark, landing, bronze_tables)
    write_zip(landing / "a.zip", [("a.csv", report(OLD, old_row(quota="2.0")))], mtime=1_741_100_000)
    load(spark, landing, bronze_tables)
    assert tuples(spark.table(bronze_tables.bronze), "VL_QUOTA") == [("1.0",), ("2.0",)]


def breaking(monkeypatch, module, name, when):
    """Make the module's ``name`` write a part and fail, the ``when``-th time."""
    real, calls = getattr(module, name), []

    def breaks(df, *rest, **more):
        calls.append(name)
        if len(calls) == when:
            real(df.limit(1), *rest, **more)
            raise RuntimeError("lost")
        return real(df, *rest, **more)

    monkeypatch.setattr(module, name, breaks)


@pytest.mark.parametrize("when", [1, 2, 3])
def test_a_run_that_broke_off_is_done_whole_by_the_next(spark, landing, bronze_tables, monkeypatch, when):
    """It breaks off within the failures, within the rows, within the record: nothing of it counts, nothing is lost."""
    from sluice.operators.loads import unfinished_loads
    from sluice.plans import bronze

    months = [old_row(fund="1", day="2025-03-03"), old_row(fund="2", day="2025-04-03")]
    write_zip(landing / "a.zip", [("good.csv", report(OLD, *months)), ("bad.csv", report(OLD, old_row(holders="x")))])
    breaking(monkeypatch, bronze, "append_part", when)
    with pytest.raises(RuntimeError):
        load(spark, landing, bronze_tables)
    monkeypatch.undo()
    assert spark.table(bronze_tables.bronze).count() == 0 and failures_of(spark, bronze_tables) == []
    assert unfinished_loads(spark, bronze_tables.log).count() == 1
    assert load(spark, landing, bronze_tables)
    assert tuples(spark.table(bronze_tables.bronze), "CNPJ_FUNDO") == [("1",), ("2",)]
    assert len(failures_of(spark, bronze_tables)) == 1
    assert not load(spark, landing, bronze_tables)


def test_a_member_without_rows_is_done_once(spark, landing, bronze_tables, monkeypatch):
    from sluice.plans import bronze

    write_zip(landing / "a.zip", [("none.csv", report(OLD)), ("folder/", "")])
    write_zip(landing / "empty.zip", [])
    done = load(spark, landing, bronze_tables)
    assert (done.archives, done.accepted, done.rows) == (2, 1, 0)
    monkeypatch.setattr(bronze, "stage_members", None)
    assert not load(spark, landing, bronze_tables)


def test_the_decoded_copy_can_be_discarded(spark, landing, bronze_tables, tmp_path, monkeypatch):
    from sluice.plans import bronze

    write_zip(landing / "a.zip", [("a.csv", report(OLD, old_row()))])
    removed = []
    real = bronze.remove_folder
    monkeypatch.setattr(bronze, "remove_folder", lambda session, folder: (removed.append(folder), real(session, folder)))
    assert load_bronze(spark, str(landing), bronze_tables, discard_staged=True)
    assert len(removed) == 1 and not Path(removed[0].removeprefix("file:")).exists()
    assert spark.table(bronze_tables.bronze).count() == 1
    with pytest.raises(ValueError):
        real(spark, str(tmp_path))


def test_results_say_what_a_load_did(spark, landing, bronze_tables):
    write_zip(landing / "a.zip", [("a.csv", report(OLD, old_row(), old_row(fund="2"))),
                                  ("b.csv", report(OLD, old_row(holders="x"), old_row(fund="")))])
    done = load(spark, landing, bronze_tables)
    assert (done.archives, done.accepted, done.rejected, done.rows, done.failures) == (1, 1, 1, 2, 2)


def test_recorded_archives_are_not_opened_and_bronze_is_not_read(spark, landing, bronze_tables):
    from sluice.plans.bronze import unseen_archives
    from sluice.sources.landing import landing_manifest

    write_zip(landing / "a.zip", [("a.csv", report(OLD, old_row()))])
    load(spark, landing, bronze_tables)
    write_zip(landing / "b.zip", [("b.csv", report(OLD, old_row()))])
    fresh = unseen_archives(spark, bronze_tables, landing_manifest(spark, str(landing)))
    assert tuples(fresh, "arquivo") == [("b.zip",)]
    plan = fresh._jdf.queryExecution().toString()
    assert f"{bronze_tables.bronze}_parts" not in plan


def damaged(path, at=None, cut=None):
    content = bytearray(path.read_bytes())
    if at is not None:
        content[at] ^= 0xFF
    path.write_bytes(bytes(content[:cut]))


def test_what_cannot_be_read_is_set_aside(spark, landing, bronze_tables):
    good = report(OLD, old_row(fund="1"))
    write_zip(landing / "a.zip", [("good.csv", good)])
    write_zip(landing / "broken.zip", [("x.csv", good)])
    damaged(landing / "broken.zip", cut=40)
    (landing / "none.zip").write_bytes(b"none")
    write_zip(landing / "changed.zip", [("first.csv", report(OLD, *[old_row(fund=str(i)) for i in range(99)])), ("second.csv", good)])
    damaged(landing / "changed.zip", at=30 + len("first.csv") + 60)
    write_zip(landing / "locked.zip", [("locked.csv", good)])
    content = bytearray((landing / "locked.zip").read_bytes())
    content[6] |= 1  # in the member's own header and in the directory's
    content[content.index(b"PK\x01\x02") + 8] |= 1
    (landing / "locked.zip").write_bytes(bytes(content))
    done = load(spark, landing, bronze_tables)
    assert tuples(spark.table(bronze_tables.bronze), "arquivo", "CNPJ_FUNDO") == [("good.csv", "1"), ("second.csv", "1")]
    told = [(r.origem_zip, r.arquivo, r.check_name) for r in spark.table(bronze_tables.failures).collect()]
    assert sorted(told, key=repr) == sorted([("broken", None, "archive_unreadable"), ("none", None, "archive_unreadable"),
                                             ("changed", "first.csv", "member_unreadable"),
                                             ("locked", "locked.csv", "member_unreadable")], key=repr)
    assert (done.accepted, done.rejected) == (2, 2) and not load(spark, landing, bronze_tables)


def test_long_fields_and_rows(spark, landing, bronze_tables):
    """A long field is a field, and a row may be longer than a block of the reader."""
    write_zip(landing / "a.zip", [("good.csv", report(OLD, old_row(fund="1"))),
                                  ("field.csv", report(OLD, old_row(fund="2" * 200_000))),
                                  ("odd.csv", report(OLD, old_row(fund="3" * 200_000) + ["x"])),
                                  ("row.csv", report(OLD, old_row(fund="4" * (70 << 20))))])
    load(spark, landing, bronze_tables)
    assert tuples(spark.table(bronze_tables.bronze), "arquivo", F.length("CNPJ_FUNDO")) == [
        ("field.csv", 200_000), ("good.csv", 1), ("row.csv", 70 << 20)]
    assert {row[3] for row in failures_of(spark, bronze_tables)} == {"field_count"}


def test_an_error_of_the_store_is_raised(spark, landing, bronze_tables, monkeypatch):
    from sluice.sources import archives
    from sluice.sources.landing import landing_manifest

    write_zip(landing / "a.zip", [("a.csv", report(OLD, old_row()))])
    gone = landing_manifest(spark, str(landing)).withColumn("path", F.concat("path", F.lit(".gone")))
    with pytest.raises(Exception, match="gone"):
        archives.listed_archives(gone).collect()


def test_only_unseen_members_are_decoded(spark, landing, bronze_tables):
    from sluice.plans.bronze import stage_members, unseen_members
    from sluice.sources.archives import archive_entries
    from sluice.sources.landing import landing_manifest

    write_zip(landing / "a.zip", [("a.csv", report(OLD, old_row(fund="1")))])
    load(spark, landing, bronze_tables)
    write_zip(landing / "b.zip", [("b.csv", report(OLD, old_row(fund="2")))])
    unseen = unseen_members(spark, bronze_tables, archive_entries(landing_manifest(spark, str(landing))))
    assert tuples(data_rows(stage_members(spark, unseen)), "arquivo") == [("b.csv",)]


def test_a_good_file_is_not_mistaken_for_a_rejected_one_of_its_name(spark, landing, bronze_tables):
    write_zip(landing / "a.zip", [("x.csv", report(OLD, old_row(holders="x")))])
    load(spark, landing, bronze_tables)
    write_zip(landing / "b.zip", [("x.csv", report(OLD, old_row()))])
    load(spark, landing, bronze_tables)
    assert spark.table(bronze_tables.bronze).count() == 1


def test_empty_landing_folder(spark, landing, bronze_tables):
    assert not load(spark, landing, bronze_tables)
    assert spark.table(bronze_tables.bronze).count() == 0


def test_missing_texts_of_the_source_reader_are_null(spark, landing, bronze_tables):
    write_zip(landing / "a.zip", [("a.csv", report(OLD, old_row(total="NA"), old_row(total="n/a"), old_row(total="na")))])
    load(spark, landing, bronze_tables)
    assert tuples(spark.table(bronze_tables.bronze), "VL_TOTAL") == [("na",), (None,), (None,)]


def test_standardise_columns_ignores_absent_names(spark):
    df = spark.createDataFrame([(1, 2)], " A_OLD  INT, B INT").toDF(" A_OLD ", "B")
    assert standardise_columns(df, {"A_OLD": "A", "C_OLD": "C"}).columns == ["A", "B"]


def test_checks_of_loose_rows(spark):
    rows = spark.createDataFrame([("f1", 1, "x", "5"), ("f1", 2, None, "5.5"), ("f2", 3, "y", "7"), ("f3", 4, "z", None)],
                                 "arquivo STRING, id INT, a STRING, n STRING")
    rules = [Rule("a"), Rule("n", kind="bigint"), Rule("missing", nullable=True)]
    found = schema_failures(rows, rules[:2], ["arquivo"], "id")
    assert tuples(found, "arquivo", "row_id", "column_name", "check_name", "failure_case") == sorted([
        ("f1", 2, "a", "not_nullable", None), ("f1", 2, "n", "dtype(bigint)", "5.5"),
        ("f3", 4, "n", "not_nullable", None)], key=repr)
    assert tuples(failure_counts(found, ["arquivo"]), "arquivo", "failures") == [("f1", 2), ("f3", 1)]
    assert tuples(accepted_rows(rows, found, ["arquivo"]), "id") == [(3,)]
    assert tuples(quarantined_rows(rows, found, ["arquivo"]), "id") == [(1,), (2,), (4,)]
    everything = schema_failures(rows, rules, ["arquivo"], "id")
    assert tuples(everything.filter("check_name = 'column_in_dataframe'"), "arquivo") == [("f1",), ("f2",), ("f3",)]


def test_rules_that_allow_everything(spark):
    rows = spark.createDataFrame([("f1", 1, None)], "arquivo STRING, id INT, a STRING")
    assert schema_failures(rows, [Rule("a", nullable=True)], ["arquivo"], "id").count() == 0


def test_guarded_append(spark, names, tmp_path):
    table, = names("rows")
    create_table(spark, table, "arquivo STRING, v INT, extra STRING", location=str(tmp_path / "rows"))
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "arquivo STRING, v INT")
    assert append_unseen(rows.filter("arquivo = 'a'"), table, ["arquivo", "v"])
    assert append_unseen(rows, table, ["arquivo", "v"])
    assert not append_unseen(rows, table, ["arquivo", "v"])
    assert tuples(spark.table(table), "arquivo", "v", "extra") == [("a", 1, None), ("b", 1, None)]


def test_loads_side_by_side_count_each_file_once(spark, landing, bronze_tables, monkeypatch):
    """A second load runs from start to end inside the first; both have the same files and each some of their own."""
    from sluice.plans import bronze

    write_zip(landing / "a.zip", [("x.csv", report(OLD, old_row(fund="1"), old_row(fund="2"))),
                                  ("bad.csv", report(OLD, old_row(holders="x")))])
    (landing / "broken.zip").write_bytes(b"no archive")
    outer = bronze.begin_bronze(spark, str(landing), bronze_tables)
    write_zip(landing / "b.zip", [("y.csv", report(OLD, old_row(fund="3")))])
    assert load(spark, landing, bronze_tables).archives == 3
    before = [tuples(spark.table(t), "*") for t in (bronze_tables.bronze, bronze_tables.failures, bronze_tables.record)]
    assert bronze.complete_bronze(spark, outer, bronze_tables).archives == 2
    after = [tuples(spark.table(t), "*") for t in (bronze_tables.bronze, bronze_tables.failures, bronze_tables.record)]
    assert after == before and len(after[0]) == 3 and len(after[1]) == 2 and len(after[2]) == 6
    assert not load(spark, landing, bronze_tables)
    assert not bronze.unseen_archives(spark, bronze_tables, bronze.landing_manifest(spark, str(landing))).count()


def test_the_first_to_finish_has_the_claim(spark, landing, bronze_tables):
    """The inner load has seen less: what only the outer one took up stays with that."""
    from sluice.operators.loads import counted_of
    from sluice.plans import bronze

    write_zip(landing / "a.zip", [("x.csv", report(OLD, old_row(fund="1")))])
    inner = bronze.begin_bronze(spark, str(landing), bronze_tables)
    write_zip(landing / "b.zip", [("y.csv", report(OLD, old_row(fund="2")))])
    outer = bronze.begin_bronze(spark, str(landing), bronze_tables)
    third = bronze.begin_bronze(spark, str(landing), bronze_tables)
    for taken in (inner, outer, third):
        bronze.complete_bronze(spark, taken, bronze_tables)
    found = tuples(spark.table(counted_of(bronze_tables.bronze)), "CNPJ_FUNDO", "carga")
    assert found == [("1", inner.load.number), ("2", outer.load.number)]


def test_a_load_that_finishes_just_before_another_begins_is_seen(spark, landing, bronze_tables, monkeypatch):
    """It finishes after the second has looked for new files and before that has begun."""
    from sluice.plans import bronze

    write_zip(landing / "a.zip", [("x.csv", report(OLD, old_row(fund="1")))])
    real = bronze.begin_load

    def late(session, log):
        monkeypatch.setattr(bronze, "begin_load", real)
        assert load(session, landing, bronze_tables)
        return real(session, log)

    monkeypatch.setattr(bronze, "begin_load", late)
    assert load(spark, landing, bronze_tables).archives == 0
    assert spark.table(bronze_tables.bronze).count() == 1


def test_merged_loads_have_the_same_rows_in_fewer_files(spark, landing, bronze_tables, tmp_path):
    from sluice.operators.loads import log_state, parts_of, replaced_parts
    from sluice.plans import bronze

    for name in "abc":
        write_zip(landing / f"{name}.zip", [(f"{name}.csv", report(OLD, old_row(fund=name))), (f"bad{name}.csv", report(OLD, old_row(holders="x")))])
        outer = bronze.begin_bronze(spark, str(landing), bronze_tables) if name == "b" else None
        load(spark, landing, bronze_tables)
        if outer:
            bronze.complete_bronze(spark, outer, bronze_tables)

    def rows():
        return [tuples(spark.table(t), "*") for t in (bronze_tables.bronze, bronze_tables.failures, bronze_tables.record)]

    before, files = rows(), len(spark.table(parts_of(bronze_tables.bronze)).inputFiles())
    assert bronze.merge_bronze(spark, bronze_tables) and rows() == before
    assert len(log_state(spark, bronze_tables.log).done) == 1
    gone = replaced_parts(spark, bronze_tables.bronze, bronze_tables.log)
    assert gone.count() == files and len(spark.table(parts_of(bronze_tables.bronze)).inputFiles()) < 2 * files
    assert not load(spark, landing, bronze_tables) and not bronze.merge_bronze(spark, bronze_tables)
    for row in gone.collect():
        os.remove("/" + row.path.removeprefix("file:").lstrip("/"))
    spark.catalog.refreshTable(parts_of(bronze_tables.bronze))
    assert rows() == before
