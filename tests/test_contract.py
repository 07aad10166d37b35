"""The driver contract stands without the training-data package and without what that package needs."""

import importlib
import sys

import pytest

import __spark_entry__ as contract


@pytest.mark.parametrize("missing", ["duckdb", "vialume.llm", "corpus_pipeline"])
def test_queries_without_a_package(monkeypatch, missing):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("vialume.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    try:
        entry = importlib.reload(contract)
        assert len(entry.queries()) > 100 and not [n for n in entry.queries() if n.startswith("op") and n[2:3].isdigit()]
        assert set(entry.oracle_sql()) <= set(entry.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(contract)
