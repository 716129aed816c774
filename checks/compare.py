"""Run queries against their oracles: ``python -m checks.compare sf_dir [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def session(cores: str = "8", partitions: str = "8") -> SparkSession:
    return (SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", partitions)
            .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.python.sql.dataFrameDebugging.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def compare(spark, con, sf: str, name: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    if name not in ORACLES:
        return True, f"{sum(got.values())} rows (no oracle)"
    rel = con.execute(ORACLES[name])
    theirs = [d[0] for d in rel.description]
    if sorted(theirs) != columns:
        return False, f"columns {columns} / {sorted(theirs)}"
    order = [theirs.index(c) for c in columns]
    want = Counter(tuple(row[k] for k in order) for row in rel.fetchall())
    if got == want:
        return True, f"{sum(got.values())} rows"
    only_got, only_want = list((got - want).elements()), list((want - got).elements())
    return False, (f"{sum(got.values())} / {sum(want.values())} rows, differ {len(only_got)} / {len(only_want)}: "
                   f"{columns} {sorted(only_got, key=str)[:3]} / {sorted(only_want, key=str)[:3]}")


def main(sf: str, names: list[str]) -> int:
    spark, con, failed = session(), connect(sf), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or list(QUERIES):
        start = time.perf_counter()
        try:
            ok, note = compare(spark, con, sf, name)
        except Exception as e:
            ok, note = False, " ".join(str(e).split())[:500]
            if names:
                traceback.print_exc()
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.perf_counter() - start:.1f}s {note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
