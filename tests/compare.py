"""Run registered queries on Spark and their check SQL on DuckDB, compare rows.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import os
import signal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

LIMIT = int(os.environ.get("COMPARE_LIMIT", "300"))     # seconds per query

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def kind(name: str) -> str:
    """One spelling per type for both engines."""
    name = str(name).lower()
    for spark, duck in (("int", "integer"), ("string", "varchar"), ("timestamp_ntz", "timestamp")):
        if name == spark:
            return duck
    return name


def spark_side(df):
    cols = sorted(df.columns)
    types = dict(df.dtypes)
    rows = df.select(*[f"`{c}`" for c in cols]).collect()
    return cols, [kind(types[c]) for c in cols], Counter(tuple(cell(v) for v in r) for r in rows)


def duck_side(con, sql):
    cur = con.execute(sql)
    heads = [(d[0], kind(d[1])) for d in cur.description]
    rows = cur.fetchall()
    order = sorted(range(len(heads)), key=lambda i: heads[i][0])
    return ([heads[i][0] for i in order], [heads[i][1] for i in order],
            Counter(tuple(cell(r[i]) for i in order) for r in rows))


def compare(df, con, sql) -> list[str]:
    cols, types, rows = spark_side(df)
    dcols, dtypes, drows = duck_side(con, sql)
    out = []
    if cols != dcols:
        return [f"columns {cols} != {dcols}"]
    if types != dtypes:
        out.append("types " + str([(c, a, b) for c, a, b in zip(cols, types, dtypes) if a != b]))
    if rows != drows:
        extra, lack = rows - drows, drows - rows
        out.append(f"rows {sum(rows.values())} vs {sum(drows.values())}; "
                   f"spark only {sum(extra.values())}: {list(extra)[:2]}; "
                   f"sql only {sum(lack.values())}: {list(lack)[:2]} cols {cols}")
    return out


def _late(*_):
    raise TimeoutError("query took too long")


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from hourlens.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    signal.signal(signal.SIGALRM, _late)
    con, checks, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.perf_counter()
        signal.alarm(LIMIT)
        try:
            df = fn(spark, sf_dir)
            problems = compare(df, con, checks[name]) if name in checks else []
            note = "sql" if name in checks else f"rows={df.count()}"
        except Exception as e:              # report and go on with the next query
            problems, note = [f"{type(e).__name__}: {str(e)[:600]}"], "error"
        finally:
            signal.alarm(0)
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} [{note}] "
              f"{time.perf_counter() - start:.2f}s", *problems, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
