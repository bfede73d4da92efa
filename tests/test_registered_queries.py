"""Every registered query against its SQL, on the smallest tables."""

import importlib.util
from pathlib import Path

import pytest

from murmura.suite import CATALOG

_spec = importlib.util.spec_from_file_location("verify", Path(__file__).resolve().parents[1] / "tools" / "verify.py")
verify = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(verify)


@pytest.fixture(scope="module")
def duck(data):
    return verify.duck(data)


@pytest.mark.parametrize("name", [name for name, (_, sql) in CATALOG.items() if sql is not None])
def test_query(spark, duck, data, name):
    ok, note = verify.compare(spark, duck, data, name)
    assert ok, note


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100
