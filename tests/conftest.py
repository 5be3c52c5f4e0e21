from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terracell.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4,
        checkpoint_dir=tempfile.mkdtemp(prefix="terracell-test-"),
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def square(x: float, y: float, side: float, **attrs) -> list[dict]:
    """Edges of a square, counter-clockwise from its low corner."""
    return ring([(x, y), (x + side, y), (x + side, y + side), (x, y + side)], **attrs)


def ring(corners: list[tuple[float, float]], **attrs) -> list[dict]:
    ends = corners[1:] + corners[:1]
    return [
        {**attrs, "seg": i, "x1": float(a[0]), "y1": float(a[1]), "x2": float(b[0]), "y2": float(b[1])}
        for i, (a, b) in enumerate(zip(corners, ends))
    ]
