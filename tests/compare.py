"""Run queries next to their SQL twins and report differences.

python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both sides hold the same rows, else what differs."""
    ours = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    import __spark_entry__ as entry
    from claimworks.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = duck(sf_dir), entry.oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            if name in sqls:
                result = difference(df, con, sqls[name])
                note = "ok" if result is None else f"DIFF {result}"
            else:
                note = f"rows {df.count()}"
        except Exception as e:  # noqa: BLE001
            note = f"ERROR {str(e)[:600]}"
        failed += note.startswith(("DIFF", "ERROR"))
        print(f"{name:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{len(names)} queries, {failed} failed")


if __name__ == "__main__":
    main()
