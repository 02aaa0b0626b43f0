import json
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[1])]

import sedimenta as sd  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = sd.build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def landing(tmp_path):
    """Write documents the way the source system's responses land: one line each."""

    def write(relative: str, document: dict) -> str:
        path = tmp_path / "raw" / relative
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(document))
        return str(tmp_path / "raw")

    return write


@pytest.fixture
def rows():
    """Rows as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
