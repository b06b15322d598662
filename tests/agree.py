"""Compare a query with its SQL: column names, types, row count and values in any order.

    python -m tests.agree [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def session(cpus: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("siltworks-tests")
             .config("spark.sql.shuffle.partitions", str(cpus)).config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.12g}")
    if isinstance(x, (list, dict)):
        return repr(x)
    return x


def _type(t: pa.DataType) -> str:
    names = {"large_string": "string", "string_view": "string", "large_binary": "binary"}
    text = str(t)
    if pa.types.is_decimal(t):
        return f"decimal({t.scale})"
    if pa.types.is_timestamp(t):
        return "timestamp" + ("_tz" if t.tz else "")
    return names.get(text, text)


def _bag(table: pa.Table) -> tuple[dict, Counter]:
    names = sorted(table.column_names)
    types = {n: _type(table.schema.field(n).type) for n in names}
    cols = [table.column(n).to_pylist() for n in names]
    return types, Counter(tuple(_plain(v) for v in row) for row in zip(*cols))


def differences(spark, con, name, run, sql, folder) -> list[str]:
    ours, ours_rows = _bag(run(spark, folder).toArrow())
    theirs, their_rows = _bag(con.sql(sql).to_arrow_table())
    out = []
    if set(ours) != set(theirs):
        out.append(f"columns: only ours {sorted(set(ours) - set(theirs))}, only SQL {sorted(set(theirs) - set(ours))}")
    else:
        out += [f"type of {c}: ours {ours[c]}, SQL {theirs[c]}" for c in ours if ours[c] != theirs[c]]
    n, m = sum(ours_rows.values()), sum(their_rows.values())
    if n != m:
        out.append(f"rows: ours {n}, SQL {m}")
    if ours_rows != their_rows:
        a = list((ours_rows - their_rows).items())[:2]
        b = list((their_rows - ours_rows).items())[:2]
        out.append(f"values {sorted(ours)}:\n    ours {str(a)[:700]}\n    SQL  {str(b)[:700]}")
    if n == 0:
        out.append("no rows")
    return out


def main(folder: str, wanted: list[str]) -> int:
    from siltworks.bindings import ORACLE, QUERIES

    spark, con, bad = session(), database(folder), 0
    for name, run in QUERIES.items():
        if wanted and not any(w == name or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        t0 = time.time()
        try:
            if name in ORACLE:
                found = differences(spark, con, name, run, ORACLE[name], folder)
            else:
                found = [] if run(spark, folder).count() else ["no rows"]
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:900]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - t0:.1f}s" + "".join(f"\n  {f}" for f in found), flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    where = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    sys.exit(bool(main(where, args)))
