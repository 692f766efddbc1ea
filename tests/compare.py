"""Runs registered queries and their SQL on the same tables and compares rows, names and types.

    python -m tests.compare [--sf /root/testdata/sf0.01] [name …]
"""

from __future__ import annotations

import argparse
import math
import time
from collections import Counter

import duckdb
import numpy as np

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, np.generic):
        v = v.item()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, np.ndarray):
        return tuple(_value(x) for x in v)
    return str(v) if not isinstance(v, (int, str, bool, type(None))) else v


def rows_of(frame) -> tuple[list[str], list[str], Counter]:
    names = sorted(frame.columns)
    kinds = [str(frame[n].dtype).replace("[ns]", "").replace("[us]", "") for n in names]
    columns = [[_value(v) for v in frame[n].tolist()] for n in names]
    return names, kinds, Counter(zip(*columns))


def difference(ours, theirs) -> str | None:
    """None where both pandas frames hold the same rows, else a short description."""
    (n1, k1, r1), (n2, k2, r2) = rows_of(ours), rows_of(theirs)
    if n1 != n2:
        return f"columns {n1} / {n2}"
    if k1 != k2 and len(ours):
        return f"types {list(zip(n1, k1, k2))}"
    if r1 != r2:
        only1, only2 = r1 - r2, r2 - r1
        sample = [str(x)[:300] for x in (list(only1)[:2], list(only2)[:2])]
        return f"{sum(r1.values())} / {sum(r2.values())} rows, {sum(only1.values())} / {sum(only2.values())} differ: {sample}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from newsdesk.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--skip-to")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = connect(args.sf), entry.queries(), entry.oracle_sql()
    bad = []
    for name in args.names or queries:
        start = time.time()
        try:
            ours = queries[name](spark, args.sf).toPandas()
            took = time.time() - start
            verdict = "rows only"
            if name in oracles:
                verdict = difference(ours, con.execute(oracles[name]).df()) or "ok"
        except Exception as error:  # report and go on with the next query
            took, verdict, ours = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", []
        if verdict not in ("ok", "rows only"):
            bad.append(name)
        print(f"{name:28s} {len(ours):8d} rows {took:6.2f}s  {verdict}", flush=True)
    print(f"{len(bad)} bad: {bad}")


if __name__ == "__main__":
    main()
