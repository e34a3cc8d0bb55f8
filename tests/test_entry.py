from __future__ import annotations

import __spark_entry__ as entry


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "ato", "tipo_ato", "score"]
    assert df.count() > 0


def test_registry_is_complete():
    names = entry.queries()
    assert len(names) > 90
    assert set(entry.oracle_sql()) <= set(names)
