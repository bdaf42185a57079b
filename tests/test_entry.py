"""The entry point survives what corpus operators may lack."""

from __future__ import annotations

import builtins
import sys

import pytest


@pytest.mark.parametrize("missing", ["xxhash", "tramline.llm", "corpus_pipeline", "ahocorasick_or_not"])
def test_queries_without(monkeypatch, missing):
    import __spark_entry__

    for name in [m for m in sys.modules if m.startswith(("tramline.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    plain = builtins.__import__

    def without(name, *args, **kwargs):
        if name == missing or name.startswith(f"{missing}."):
            raise ImportError(f"no {missing}", name=missing)
        return plain(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", without)
    found, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert "interval_coalesce" in found and set(sql) <= set(found)
    if missing in ("xxhash", "tramline.llm", "corpus_pipeline"):
        assert not any(q.startswith("op") or q == "pipeline" for q in found)
