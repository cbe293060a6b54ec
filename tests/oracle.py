"""Run queries next to their SQL twins: ``python -m tests.oracle [name-prefix ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
FOLDER = "/root/testdata/sf0.01"


def connect(folder: str = FOLDER):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if str(s.dtype).startswith("datetime"):
            s = s.astype("datetime64[us]").astype(str)
        elif s.dtype == object:
            s = s.map(lambda v: None if v is None or v is pd.NaT or v != v else
                      v.isoformat() if hasattr(v, "isoformat") else v)
        df[c] = s.map(lambda v: "NULL" if v is None or v is pd.NA or v != v or v == "NaT" else
                      repr(float(v)) if isinstance(v, float) else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def _kind(dtype) -> str:
    name = str(dtype).lower()
    for k in ("datetime", "float", "int", "bool"):
        if name.startswith(k) or name.startswith("u" + k):
            return k
    return "object"


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when both frames hold the same rows."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = _plain(got), _plain(want)
    bad = [c for c in a.columns if not a[c].equals(b[c])]
    if bad:
        c = bad[0]
        i = (a[c] != b[c]).idxmax()
        return f"{bad}: row {i}: {a.loc[i].to_dict()} != {b.loc[i].to_dict()}"
    return None


def main(prefixes: list[str]) -> int:
    from gridspan import build_session, catalog

    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                   "spark.ui.enabled": "false",
                                                   "spark.ui.showConsoleProgress": "false",
                                                   "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(), 0
    for name, fn in catalog.QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t = time.time()
        try:
            got = fn(spark, FOLDER).toPandas()
            seconds = time.time() - t
            if name in catalog.ORACLES:
                want = con.execute(catalog.ORACLES[name]).df()
                problem = differences(got, want)
                kinds = {c: (_kind(got[c].dtype), _kind(want[c].dtype)) for c in got.columns
                         if not problem and _kind(got[c].dtype) != _kind(want[c].dtype)
                         and len(got)}
            else:
                problem, kinds = None, {}
        except Exception as e:  # report and go on
            problem, seconds, kinds, got = f"{type(e).__name__}: {str(e)[:700]}", time.time() - t, {}, []
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={len(got)} {seconds:.2f}s"
              f"{'' if name in catalog.ORACLES else ' (rows only)'} {kinds or ''} {problem or ''}",
              flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
