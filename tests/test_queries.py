"""Every core query against its SQL on the smallest tables."""

import pytest

from shelfmark import plans

PAIRS = [(n, f, m.oracle_sql().get(n)) for m in plans.modules() for n, f in m.queries().items()]


def norm(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name,query,sql", PAIRS, ids=[p[0] for p in PAIRS])
def test_query(spark, duck, data, name, query, sql):
    df = query(spark, data)
    cols = sorted(df.columns)
    got = norm(tuple(r[c] for c in cols) for r in df.collect())
    if sql:
        rel = duck.sql(sql)
        names = rel.columns
        assert sorted(names) == cols
        assert got == norm(tuple(r[names.index(c)] for c in cols) for r in rel.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
