"""A library that llm needs is missing: the core queries are still there."""

from __future__ import annotations

import sys

import pytest

import __spark_entry__ as entry
from millrace.plans import core_queries


def test_missing_library(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("millrace.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ahocorasick", None)
    with pytest.warns(UserWarning):
        assert set(entry.queries()) == set(core_queries.QUERIES)
