"""Compare registered queries with their SQL on DuckDB. `python tests/oracle.py <dir> [name ...]`"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(path).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, decimal.Decimal, int)):
        f = float(value)
        return "nan" if math.isnan(f) else round(f, 9)
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


FAMILIES = {
    "whole": ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UBIGINT", "UINTEGER", "byte", "short", "integer", "long"),
    "number": ("FLOAT", "DOUBLE", "DECIMAL", "float", "double", "decimal"),
    "text": ("VARCHAR", "string"),
    "truth": ("BOOLEAN", "boolean"),
    "date": ("DATE", "date"),
    "time": ("TIMESTAMP", "timestamp"),
    "list": ("LIST", "array"),
    "row": ("STRUCT", "MAP", "struct", "map"),
    "bytes": ("BLOB", "binary"),
}


def family(kind):
    """Whole number, number, text and so on, of a Spark or DuckDB type name."""
    name = "LIST" if kind.endswith("]") else kind
    return next((f for f, names in FAMILIES.items() if name.startswith(names)), kind)


def schema_problem(df, cur):
    """What differs between the kinds of the columns, if anything."""
    want = {d[0]: family(str(d[1])) for d in cur.description}
    got = {f.name: family(f.dataType.typeName()) for f in df.schema}
    odd = {c: (got[c], want[c]) for c in got if got[c] != want[c] and want[c] != "NULL"}
    return f"kinds {odd}" if odd else ""


def compare(spark, con, name, query, sql, path):
    """Empty text if the results agree, else what differs."""
    df = query(spark, path)
    got_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} against {sorted(want_cols)}"
    if problem := schema_problem(df, cur):
        return problem
    got, want = normal(df.columns, got_rows), normal(want_cols, want_rows)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from medley import session

    path, names = sys.argv[1], sys.argv[2:]
    spark = session.build(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(path), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, name, query, sqls[name], path)
            else:
                problem = "" if query(spark, path).count() else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
