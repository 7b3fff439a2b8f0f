from __future__ import annotations

import os
import sys
import zipfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sluice import layouts  # noqa: E402
from sluice.plans import bronze, control, silver  # noqa: E402
from sluice.session import build_session  # noqa: E402

OLD = list(layouts.REPORT_COLUMNS)
NEW = ["TP_FUNDO_CLASSE", "CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", *layouts.REPORT_COLUMNS[2:]]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


@pytest.fixture
def names(request):
    """Table names of one test."""
    label = "".join(c if c.isalnum() else "_" for c in request.node.name)
    return lambda *kinds: [f"{label}_{kind}" for kind in kinds]


@pytest.fixture
def bronze_tables(spark, names, tmp_path):
    tables = bronze.BronzeTables(*names("bronze", "failures"))
    bronze.create_bronze(spark, tables, location=str(tmp_path / "tables"))
    return tables


@pytest.fixture
def silver_tables(spark, names, tmp_path):
    tables = silver.SilverTables(*names("silver", "rejects"))
    silver.create_silver(spark, tables, location=str(tmp_path / "tables"))
    return tables


@pytest.fixture
def control_tables(spark, names, tmp_path):
    tables = control.ControlTables(*names("control", "members"))
    control.create_control(spark, tables, location=str(tmp_path / "tables"))
    return tables


def write_zip(path: Path, members, when=(2025, 3, 5, 9, 10, 12), mtime: int = 1_741_000_000) -> None:
    """An archive of (name, text) pairs, in latin-1, with fixed times."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members:
            content = text if isinstance(text, bytes) else text.encode("latin-1")
            archive.writestr(zipfile.ZipInfo(name, when), content)
    os.utime(path, (mtime, mtime))


def report(header, *rows) -> str:
    return "\n".join([";".join(header), *(";".join(row) for row in rows), ""])


def old_row(fund="11", day="2025-03-03", quota="1.5", total="10", holders="7", kind="FI"):
    return [kind, fund, day, total, quota, "100.25", "3", "4", holders]


def new_row(fund="11", day="2025-03-03", quota="1.5", total="10", holders="7", kind="CLASSES - FIF", subclass="S1"):
    return [kind, fund, subclass, day, total, quota, "100.25", "3", "4", holders]


def tuples(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
