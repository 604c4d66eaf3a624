"""The entry module without its optional subpackage."""
import sys
import warnings

import pytest

import __spark_entry__ as E


@pytest.mark.parametrize("missing", ["estuary.llm", "public_tokenizers"])
def test_entry_without_the_optional_subpackage(monkeypatch, missing):
    for name in [m for m in sys.modules if m.startswith("estuary.llm") or m in ("corpus_pipeline", missing)]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)  # an import of it fails
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 155 and set(o) <= set(q)
    assert not any(k.startswith("op") and k[2].isdigit() or k == "pipeline" for k in q)
