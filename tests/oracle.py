"""Run a query in Spark and its SQL in DuckDB, and compare them."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with every driver table as a view."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs: names, types, rows; empty when the two agree."""
    names = sorted(spark_df.columns)
    result = con.execute(sql)
    sql_names = [d[0] for d in result.description]
    sql_types = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    found = []
    if names != sorted(sql_names):
        return [f"columns {names} against {sorted(sql_names)}"]
    for field in spark_df.schema.fields:
        kind = field.dataType.simpleString()
        if _KINDS.get(kind, kind) != sql_types[field.name]:
            found.append(f"type of {field.name}: {kind} against {sql_types[field.name]}")
    ours = Counter(
        tuple(_plain(r[n]) for n in names) for r in spark_df.select(*names).collect()
    )
    order = [sql_names.index(n) for n in names]
    theirs = Counter(tuple(_plain(r[i]) for i in order) for r in rows)
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        found.append(
            f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only Spark {sum(extra.values())}: {list(extra)[:3]}; "
            f"only SQL {sum(missing.values())}: {list(missing)[:3]}"
        )
    return found


def main(sf_dir: str, *wanted: str) -> int:
    """Check the named queries (all by default) and print one line each."""
    from __spark_entry__ import oracle_sql, queries
    from savormap.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, plan in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = plan(spark, sf_dir)
            if name in sql:
                found = differences(df, con, sql[name])
                note = "same" if not found else "DIFFERS " + " | ".join(found)
            else:
                found, note = [], f"rows {df.count()}"
        except Exception as error:  # noqa: BLE001
            found, note = [str(error)], "FAILED " + str(error)[:700]
        bad += bool(found)
        print(f"{time.time() - start:6.1f}s {name}: {note[:1200]}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
