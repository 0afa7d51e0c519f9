"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def differences(spark, con, name: str, sf_dir: str, queries, oracles) -> list[str]:
    """What differs between Spark and SQL; empty when all is equal."""
    df = queries[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(oracles[name])
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} <> {sorted(names)}"]
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {oracles[name]}").fetchall()}
    for field, kind in df.dtypes:
        if SPARK_TYPES.get(kind, kind) != types[field]:
            out.append(f"type of {field}: {kind} <> {types[field]}")
    if got != want:
        extra, lost = got - want, want - got
        out.append(f"rows {sum(got.values())} vs {sum(want.values())}; "
                   f"{sum(extra.values())} only in Spark, {sum(lost.values())} only in SQL")
        out += [f"  spark {str(r)[:400]}" for r in list(extra)[:2]]
        out += [f"  sql   {str(r)[:400]}" for r in list(lost)[:2]]
    if not want:
        out.append("no rows at all")
    return out


def main() -> None:
    from corpusprep.catalog import ORACLES, QUERIES
    from corpusprep.session import build_session

    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(f"{DATA}/{sf}")
    for name in wanted or QUERIES:
        start = time.time()
        try:
            if name not in ORACLES:
                n = QUERIES[name](spark, f"{DATA}/{sf}").count()
                bad = [] if n else ["no rows"]
            else:
                bad = differences(spark, con, name, f"{DATA}/{sf}", QUERIES, ORACLES)
        except Exception as exc:  # report and go on
            bad = [f"{type(exc).__name__}: {str(exc)[:700]}"]
        print("ok  " if not bad else "FAIL", name, f"{time.time() - start:.1f}s", flush=True)
        for line in bad:
            print("     ", line)


if __name__ == "__main__":
    main()
