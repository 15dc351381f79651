"""The driver's entry point with and without the optional files."""

import sys

import __spark_entry__ as contract
from epipanel.plans import catalog


def test_without_the_optional_subpackage(monkeypatch):
    # as if the folder, or a package that it needs, were not there
    for name in [m for m in sys.modules if m == "epipanel.llm" or m.startswith("epipanel.llm.")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "epipanel.llm", None)
    assert set(contract.queries()) == set(catalog.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
