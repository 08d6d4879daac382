"""The entry module without the training-data subpackage."""

from __future__ import annotations

import importlib.util
import sys

import __spark_entry__ as entry_module
from briefloom.plans.oracle import ORACLE
from briefloom.plans.queries import QUERIES


def test_queries_load_without_the_training_data_operators(monkeypatch):
    real = importlib.util.find_spec
    monkeypatch.setattr(entry_module, "find_spec", lambda name: None if name == "briefloom.llm" else real(name))
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("briefloom.llm")]:
        monkeypatch.setitem(sys.modules, name, None)  # importing it raises
    assert entry_module.queries() == QUERIES
    assert entry_module.oracle_sql() == ORACLE


def test_operator_queries_are_added_where_they_are_installed():
    found = importlib.util.find_spec("briefloom.llm")
    names = {n for n in entry_module.queries() if n not in QUERIES}
    assert bool(names) == bool(found and found.origin)
