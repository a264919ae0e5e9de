from __future__ import annotations

from datetime import date, datetime

import pytest

from footfall.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as a sorted list of plain tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


def day(text: str) -> date:
    return date.fromisoformat(text)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)
