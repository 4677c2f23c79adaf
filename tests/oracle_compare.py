"""A query's rows beside its DuckDB SQL's, both over the same Parquet tables."""

import math
from pathlib import Path

import duckdb


def differences(got, sql: str, sf_dir: str) -> str | None:
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    cols = sorted(got.columns)
    if cols != sorted(names):
        return f"columns {cols} and {sorted(names)}"
    def clean(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 7) + 0.0
        return int(v) if type(v).__name__ == "Decimal" else v

    a = sorted((tuple(clean(r[c]) for c in cols) for r in got.collect()), key=str)
    at = [names.index(c) for c in cols]
    b = sorted((tuple(clean(r[i]) for i in at) for r in want.fetchall()), key=str)
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows"
    return next((f"{x} and {y}" for x, y in zip(a, b) if x != y), None)
