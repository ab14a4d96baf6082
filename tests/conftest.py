"""Session and file fixtures."""

from __future__ import annotations

import csv
import uuid
from pathlib import Path

import pytest

from wardline.schema import FILE_COLUMNS
from wardline.session import build_session
from wardline.sources.warehouse import Warehouse

# The rows every load test starts from: two with an ID, one without.
SAMPLE_ROWS = [
    {
        "Crime ID": "wl-0001",
        "Month": "2026-02",
        "Reported by": "Northmoor Constabulary",
        "Falls within": "Northmoor Constabulary",
        "Longitude": "-2.5",
        "Latitude": "54.25",
        "Location": "Beside the canal basin",
        "LSOA code": "X00000017",
        "LSOA name": "Northmoor 017C",
        "Crime type": "Robbery",
        "Last outcome category": "Under investigation",
    },
    {
        "Crime ID": "wl-0002",
        "Month": "2026-02",
        "Reported by": "Northmoor Constabulary",
        "Falls within": "Northmoor Constabulary",
        "Longitude": "-2.625",
        "Latitude": "54.375",
        "Location": "Tram depot, east gate",
        "LSOA code": "X00000023",
        "LSOA name": "Northmoor 023A",
        "Crime type": "Vehicle crime",
        "Last outcome category": "Offender given a caution",
    },
    {
        "Month": "2026-02",
        "Reported by": "Northmoor Constabulary",
        "Falls within": "Northmoor Constabulary",
        "Longitude": "-2.75",
        "Latitude": "54.5",
        "Location": "Market hall",
        "LSOA code": "X00000031",
        "LSOA name": "Northmoor 031B",
        "Crime type": "Drugs",
    },
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    """An empty warehouse with databases of its own."""
    house = Warehouse(spark, str(tmp_path / "tables"), f"t{uuid.uuid4().hex[:8]}_")
    house.initialise()
    return house


def sample_rows(month="2026-02", copies=1, ids=""):
    rows = []
    for copy in range(copies):
        for row in SAMPLE_ROWS:
            made = {**row, "Month": month}
            if made.get("Crime ID"):
                made["Crime ID"] += f"{ids}-{copy}" if copies > 1 or ids else ""
            rows.append(made)
    return rows


def write_csv(path: Path, rows: list[dict], columns=tuple(FILE_COLUMNS), encoding="utf-8") -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding=encoding) as file:
        writer = csv.DictWriter(file, fieldnames=list(columns), restval="")
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


@pytest.fixture
def sample_csv(tmp_path):
    return write_csv(tmp_path / "inbox" / "2026-02-west-yorkshire-street.csv", sample_rows())
