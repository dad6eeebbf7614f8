"""Run every query beside its SQL and compare: ``python -m contract.check [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

from contract.queries import ORACLES, QUERIES
from ingotflow.session import create_session


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sorted_rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    for name, column in frame.items():
        if pd.api.types.is_datetime64_any_dtype(column):
            frame = frame.assign(**{name: column.dt.strftime("%Y-%m-%d %H:%M:%S.%f")})

    def shown(value):
        if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
            return ""
        return value if isinstance(value, str) else repr(value)

    return sorted(tuple(shown(v) for v in row)
                  for row in frame.astype(object).itertuples(index=False))


def difference(df: DataFrame, sql: str, connection: duckdb.DuckDBPyConnection) -> str | None:
    """What differs between a Spark result and its SQL, or None. Exact, doubles included."""
    relation = connection.sql(sql)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    ours = {name: kinds.get(kind, kind) for name, kind in df.dtypes}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if ours != theirs:
        return f"types {ours} against {theirs}"
    days = [name for name, kind in theirs.items() if kind == "DATE"]
    shown = df.withColumns({name: df[name].cast("timestamp_ntz") for name in days})
    mine, other = _sorted_rows(shown.toPandas()), _sorted_rows(relation.df())
    if mine == other:
        return None
    unlike = next((pair for pair in zip(mine, other) if pair[0] != pair[1]), None)
    return f"{len(mine)} rows against {len(other)}; first unlike pair {unlike}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = create_session("check", **{"spark.ui.enabled": "false",
                                       "spark.ui.showConsoleProgress": "false",
                                       "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failures = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(QUERIES[name](spark, sf_dir), ORACLES[name], connection)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"{time.time() - start:7.2f}s {name}: {problem or 'equal'}", flush=True)
    print(f"{len(names) - failures} of {len(names)} equal")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
