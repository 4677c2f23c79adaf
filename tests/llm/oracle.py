"""Comparing a query with its DuckDB SQL on given tables."""

import duckdb


def same(got, sql, ordered=False, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow() if hasattr(df, "toArrow") else df)
    want = con.execute(sql).to_arrow_table()
    cols = sorted(got.columns)
    assert cols == sorted(want.column_names)
    clean = lambda v: round(v, 6) if isinstance(v, float) else int(v) if type(v).__name__ == "Decimal" else v
    a = sorted((tuple(clean(r[c]) for c in cols) for r in got.collect()), key=str)
    b = sorted((tuple(clean(r[c]) for c in cols) for r in want.to_pylist()), key=str)
    assert len(a) == len(b)
    assert a == b, next((x, y) for x, y in zip(a, b) if x != y)
