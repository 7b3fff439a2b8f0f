from __future__ import annotations

import os
import random
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from sluice import layouts
from sluice.functions.dates import period_columns
from sluice.operators.versions import latest_version
from sluice.plans.bronze import append_rows
from sluice.plans.silver import days_of_months, in_months, load_silver, silver_candidates, silver_current
from sluice.streaming.silver_feed import feed_silver

COLUMNS = "TP_FUNDO", "CNPJ_FUNDO", "DT_COMPTC", "VL_QUOTA", "DATA_MODIFICACAO"


def bronze_rows(spark, rows):
    """Rows of (fund, date text, quota, version day of March 2025[, sub-class])."""
    full = [("FI", r[0], r[1], "1", r[2], "2", "3", "4", 5, "a.csv", datetime(2025, 3, r[3]), None, None,
             r[4] if len(r) > 4 else None) for r in rows]
    return spark.createDataFrame(full, layouts.BRONZE_COLUMNS).withColumns(period_columns(F.col("DT_COMPTC")))


def silver_rows(spark, tables):
    return tuples(spark.table(tables.silver), "CNPJ_FUNDO", "DT_COMPTC", "VL_QUOTA",
                  F.dayofmonth("DATA_MODIFICACAO").alias("v"))


def test_the_later_of_two_versions_is_loaded(spark, bronze_tables, silver_tables):
    append_rows(spark, bronze_rows(spark, [("1", "2025-01-02", "1.0", 1), ("1", "2025-01-02", "2.0", 2)]), bronze_tables)
    load_silver(spark, bronze_tables.bronze, silver_tables)
    assert silver_rows(spark, silver_tables) == [("1", date(2025, 1, 2), Decimal("2.00"), 2)]


def test_a_later_version_is_added_and_the_older_stays(spark, bronze_tables, silver_tables):
    for quota, version in (("1.0", 1), ("2.0", 2), ("1.5", 1)):
        append_rows(spark, bronze_rows(spark, [("1", "2025-01-02", quota, version)]), bronze_tables)
        load_silver(spark, bronze_tables.bronze, silver_tables)
        load_silver(spark, bronze_tables.bronze, silver_tables)
    assert silver_rows(spark, silver_tables) == [("1", date(2025, 1, 2), Decimal("1.00"), 1),
                                                ("1", date(2025, 1, 2), Decimal("2.00"), 2)]
    assert tuples(silver_current(spark.table(silver_tables.silver)), "VL_QUOTA") == [(Decimal("2.00"),)]


def test_rows_without_a_date_are_set_aside_once(spark, bronze_tables, silver_tables):
    append_rows(spark, bronze_rows(spark, [("1", "2025-13-01", "1.0", 1), ("2", "2025-01-02", "1.0", 1)]), bronze_tables)
    for _ in range(2):
        load_silver(spark, bronze_tables.bronze, silver_tables)
    assert [row[0] for row in silver_rows(spark, silver_tables)] == ["2"]
    assert tuples(spark.table(silver_tables.rejects), "CNPJ_FUNDO", "DT_COMPTC") == [("1", "2025-13-01")]


def test_versions_are_ranked_per_date_text(spark):
    """Two spellings of a date are two partitions of the ranking."""
    found = silver_candidates(bronze_rows(spark, [("1", "2025-01-02", "1.0", 1), ("1", "2025-1-2", "2.0", 2)]))
    assert tuples(found, "DT_COMPTC", "VL_QUOTA") == [(date(2025, 1, 2), Decimal("1.00")),
                                                      (date(2025, 1, 2), Decimal("2.00"))]


def test_ties_are_settled_the_same_way_in_any_order(spark):
    rows = [("1", "2025-01-02", str(i), 1, f"S{i % 7}") for i in range(40)]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        seen.add(tuple(tuples(silver_candidates(bronze_rows(spark, rows).repartition(4)), "VL_QUOTA")))
    assert len(seen) == 1


def test_sub_classes_can_be_keys(spark):
    rows = [("1", "2025-01-02", "1", 1, "S1"), ("1", "2025-01-02", "2", 1, "S2")]
    found = silver_candidates(bronze_rows(spark, rows), extra_keys=["ID_SUBCLASSE"])
    assert tuples(found, "ID_SUBCLASSE", "VL_QUOTA") == [("S1", Decimal("1.00")), ("S2", Decimal("2.00"))]


def test_amounts_with_a_comma(spark):
    assert tuples(silver_candidates(bronze_rows(spark, [("1", "2025-01-02", "1234,565", 1)])), "VL_QUOTA") == [
        (Decimal("1234.57"),)]


def random_rows(seed, count=300):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        day = f"2025-{rng.choice([1, 2, 3, 12, 13]):02d}-{rng.randint(1, 3):02d}"
        fund = "hot" if rng.random() < 0.34 else str(rng.randint(1, 5))
        rows.append((fund, day, f"{rng.randint(0, 9)}.5", rng.randint(1, 9)))
    return rows


def brute_force(loaded, rows):
    """Silver after loading all of ``rows`` on top of ``loaded``, as sets of (fund, date, version)."""
    newest = {}
    for fund, day, _, version in rows:
        if day[5:7] <= "12":
            newest[fund, day] = max(newest.get((fund, day), 0), version)
    return loaded | {(*key, version) for key, version in newest.items()}


@pytest.mark.parametrize("how", ["whole", "feed"])
def test_loads_agree_with_brute_force(spark, bronze_tables, silver_tables, tmp_path, how):
    seen, expected = [], set()
    for seed in range(3):
        batch = random_rows(seed)
        seen += batch
        append_rows(spark, bronze_rows(spark, batch), bronze_tables)
        if how == "whole":
            load_silver(spark, bronze_tables.bronze, silver_tables)
        else:
            feed_silver(spark, bronze_tables.bronze, silver_tables, str(tmp_path / "feed"))
        expected = brute_force(expected, seen)
        found = [(fund, str(day), version) for fund, day, _, version in silver_rows(spark, silver_tables)]
        assert sorted(found) == sorted(expected)
    # A file version is rejected by the first load that meets it, with all the rows it has then.
    bad, versions = 0, set()
    for seed in range(3):
        batch = [r for r in random_rows(seed) if r[1][5:7] == "13"]
        bad += sum(r[3] not in versions for r in batch)
        versions |= {r[3] for r in batch}
    assert spark.table(silver_tables.rejects).count() == bad


def test_the_feed_reads_changed_months_only(spark, bronze_tables, silver_tables, tmp_path, monkeypatch):
    from sluice.streaming import silver_feed

    asked = []
    real = silver_feed.load_silver

    def recorded(session, bronze, tables, months, extra_keys):
        asked.append(sorted(months, key=repr))
        real(session, bronze, tables, months, extra_keys)

    monkeypatch.setattr(silver_feed, "load_silver", recorded)
    for rows in ([("1", "2025-01-02", "1", 1), ("1", "2025-02-02", "1", 1)], [("1", "2025-02-02", "2", 2)], []):
        append_rows(spark, bronze_rows(spark, rows), bronze_tables)
        feed_silver(spark, bronze_tables.bronze, silver_tables, str(tmp_path / "feed"))
    assert asked == [[(2025, 1), (2025, 2)], [(2025, 2)]]
    assert len(silver_rows(spark, silver_tables)) == 3


def test_month_filters_prune_partitions(spark, bronze_tables, silver_tables):
    months = [(2024, 12), (2025, 1), (2025, 3), (None, None)]
    days = [date(2024, 11, 30), date(2024, 12, 1), date(2025, 1, 31), date(2025, 2, 1), date(2025, 3, 31), date(2025, 4, 1)]
    df = spark.createDataFrame([(d, d.year, d.month) for d in days] + [(None, None, None)], "day DATE, ano INT, mes INT")
    assert tuples(df.filter(days_of_months(months, F.col("day"))), "day") == [(days[1],), (days[2],), (days[4],)]
    assert df.filter(in_months(months)).count() == 4

    append_rows(spark, bronze_rows(spark, [("1", "2025-01-02", "1", 1), ("1", "2025-02-02", "1", 1)]), bronze_tables)
    plan = spark.table(bronze_tables.bronze).filter(in_months([(2025, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*isnotnull\(ano", plan)


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                      F.col("id").alias("v")).repartition(8)
    newest = latest_version(rows, ["k"], "v")
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert newest.count() == 20_001
    assert newest.filter("k = 'hot'").first().v == 29_997


@pytest.mark.parametrize("how", ["whole", "feed"])
def test_years_beyond_the_calendar_of_python(spark, bronze_tables, silver_tables, tmp_path, how):
    rows = [("1", day, "1", 1) for day in ("0000-01-02", "0001-01-02", "9999-12-31", "20205-01-02", "-0001-01-02")]
    append_rows(spark, bronze_rows(spark, rows), bronze_tables)
    for _ in range(2):
        if how == "whole":
            load_silver(spark, bronze_tables.bronze, silver_tables)
        else:
            feed_silver(spark, bronze_tables.bronze, silver_tables, str(tmp_path / "feed"))
    found = [row[0] for row in tuples(spark.table(silver_tables.silver), F.year("DT_COMPTC"))]
    assert sorted(found) == [-1, 0, 1, 9999, 20205]


def test_equal_rejects_stay_apart(spark, bronze_tables, silver_tables):
    append_rows(spark, bronze_rows(spark, [("1", "no date", "1", 1)] * 3), bronze_tables)
    for _ in range(2):
        load_silver(spark, bronze_tables.bronze, silver_tables)
    assert spark.table(silver_tables.rejects).count() == 3


def test_old_files_of_bronze_reach_silver(spark, bronze_tables, silver_tables, tmp_path):
    append_rows(spark, bronze_rows(spark, [("1", "2025-01-02", "1", 1)]), bronze_tables)
    feed_silver(spark, bronze_tables.bronze, silver_tables, str(tmp_path / "feed"))
    append_rows(spark, bronze_rows(spark, [("2", "2025-02-02", "1", 1)]), bronze_tables)
    old = 1_600_000_000
    for folder, _, files in os.walk(tmp_path / "tables"):
        for name in files:
            if "carga=" in folder or os.path.getmtime(f"{folder}/{name}") == max(
                    os.path.getmtime(f"{folder}/{n}") for n in files):
                os.utime(f"{folder}/{name}", (old, old))
    feed_silver(spark, bronze_tables.bronze, silver_tables, str(tmp_path / "feed"))
    assert [row[0] for row in silver_rows(spark, silver_tables)] == ["1", "2"]


@pytest.mark.parametrize("how", ["whole", "feed"])
@pytest.mark.parametrize("when", [1, 2])
def test_a_load_that_broke_off_is_done_whole_by_the_next(spark, bronze_tables, silver_tables, tmp_path, monkeypatch, how, when):
    """It breaks off within silver or within the rejects, with some of the rows written: nothing of it counts."""
    from sluice.operators.loads import unfinished_loads
    from sluice.plans import silver

    rows = [(str(i), "2025-01-02", "1", 1) for i in range(6)] + [(str(i), "no date", "1", 1) for i in range(6)]
    append_rows(spark, bronze_rows(spark, rows), bronze_tables)
    real, calls = silver.append_part, []

    def breaks(df, *rest, **more):
        calls.append(rest)
        real(df.limit(2) if len(calls) == when else df, *rest, **more)
        if len(calls) == when:
            raise RuntimeError("lost")

    def run():
        if how == "whole":
            load_silver(spark, bronze_tables.bronze, silver_tables)
        else:
            feed_silver(spark, bronze_tables.bronze, silver_tables, str(tmp_path / "feed"))

    monkeypatch.setattr(silver, "append_part", breaks)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.undo()
    assert spark.table(silver_tables.silver).count() == spark.table(silver_tables.rejects).count() == 0
    assert unfinished_loads(spark, silver_tables.log).count() == 1
    assert silver.uncovered_loads(spark, bronze_tables.bronze, silver_tables).count() == 1
    for _ in range(2):
        run()
        assert spark.table(silver_tables.silver).count() == spark.table(silver_tables.rejects).count() == 6
    assert silver.uncovered_loads(spark, bronze_tables.bronze, silver_tables).count() == 0


def test_silver_loads_side_by_side_add_each_version_once(spark, bronze_tables, silver_tables, monkeypatch):
    from sluice.plans import silver

    append_rows(spark, bronze_rows(spark, [("1", "2025-01-02", "1", 1), ("2", "2025-02-02", "1", 1), ("3", "no date", "1", 1)]),
                bronze_tables)
    real = silver.silver_candidates

    def nested(*rest):
        monkeypatch.setattr(silver, "silver_candidates", real)
        append_rows(spark, bronze_rows(spark, [("1", "2025-01-02", "2", 2)]), bronze_tables)
        load_silver(spark, bronze_tables.bronze, silver_tables)
        return real(*rest)

    monkeypatch.setattr(silver, "silver_candidates", nested)
    load_silver(spark, bronze_tables.bronze, silver_tables)
    assert [(r[0], r[3]) for r in silver_rows(spark, silver_tables)] == [("1", 1), ("1", 2), ("2", 1)]
    assert spark.table(silver_tables.rejects).count() == 1
    assert silver.merge_silver(spark, silver_tables)
    assert [(r[0], r[3]) for r in silver_rows(spark, silver_tables)] == [("1", 1), ("1", 2), ("2", 1)]
    assert spark.table(silver_tables.rejects).count() == 1


def test_rejects_seen_are_read_in_changed_months_only(spark, bronze_tables, silver_tables):
    append_rows(spark, bronze_rows(spark, [("1", "2025-01-02", "1", 1)]), bronze_tables)
    plan = spark.table(silver_tables.rejects).filter(in_months([(2025, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*isnotnull\(ano", plan)
