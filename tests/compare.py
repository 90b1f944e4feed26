"""Side-by-side run of registered queries in Spark and their oracles in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canon(value) -> str:
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, float):
        return "∅" if math.isnan(value) else f"f{value + 0.0!r}"
    return str(value)


def rows_of(rows, cols) -> list[tuple[str, ...]]:
    order = sorted(range(len(cols)), key=cols.__getitem__)
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def close(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
    """Equal up to the last digits of doubles."""
    def same(x: str, y: str) -> bool:
        if x == y:
            return True
        if not (x.startswith("f") and y.startswith("f")):
            return False
        return math.isclose(float(x[1:]), float(y[1:]), rel_tol=1e-7, abs_tol=1e-4)

    return all(same(x, y) for x, y in zip(a, b))


def differences(df, con, sql: str, loose: bool = False) -> str | None:
    """None if both sides agree, else what differs."""
    cols = df.columns
    mine = rows_of([tuple(r) for r in df.collect()], cols)
    result = con.execute(sql)
    theirs_cols = [d[0] for d in result.description]
    theirs = rows_of(result.fetchall(), theirs_cols)
    if sorted(cols) != sorted(theirs_cols):
        return f"columns {sorted(cols)} != {sorted(theirs_cols)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b and not (loose and close(a, b))]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, e.g. {sorted(cols)} {bad[0][0]} != {bad[0][1]}"
    return None
