"""Run registered queries beside their reference SQL: `python tests/oracle_check.py [folder] [name ...]`."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), ignore_index=True) if len(frame.columns) else frame


def differences(spark, con, name: str, build, sql: str, folder: str) -> str | None:
    """None when the two results are equal, else what differs first."""
    ours = normal(build(spark, folder).toPandas())
    theirs = normal(con.execute(sql).df())
    if list(ours.columns) != list(theirs.columns):
        return f"columns {list(ours.columns)} != {list(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for c in ours.columns:
        if ours[c].dtype.kind != theirs[c].dtype.kind:
            return f"{c}: types {ours[c].dtype} != {theirs[c].dtype}"
        same = (ours[c] == theirs[c]) | (ours[c].isna() & theirs[c].isna())
        if not same.all():
            at = same.idxmin()
            return f"{c}: {(~same).sum()} of {len(same)} rows differ, first\n{ours.loc[at]}\n{theirs.loc[at]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from metricloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    session, con = local_session(), connect(folder)
    built, sqls = entry.queries(), entry.oracle_sql()
    failed = []
    for name in wanted or built:
        start = time.time()
        try:
            if name in sqls:
                problem = differences(session, con, name, built[name], sqls[name], folder)
            else:
                problem = None if built[name](session, folder).count() else "no rows"
        except Exception as error:  # report every query, then fail at the end
            problem = f"{type(error).__name__}: {str(error)[:800]}"
        verdict = "ok" if problem is None else f"FAILED {problem}"
        print(f"{time.time() - start:6.1f}s {'sql ' if name in sqls else 'rows'} {name}: {verdict}", flush=True)
        failed += [name] if problem else []
    print(f"{len(failed)} failed: {failed}; oracle without query: {sorted(set(sqls) - set(built))}")
    sys.exit(bool(failed))
