"""The driver's contract, with and without the subpackage llm."""

from __future__ import annotations

import sys
import warnings

import __spark_entry__ as entry
from millrace.plans import core_queries


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(core_queries.QUERIES) <= set(entry.queries())


def test_core_queries_stay_where_llm_cannot_be_imported(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("millrace.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "millrace.llm", None)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert set(entry.queries()) == set(core_queries.QUERIES) and set(entry.oracle_sql()) == set(core_queries.SQL)
