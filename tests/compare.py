"""Order-insensitive comparison of a Spark result with an SQL result on the same tables."""

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(row[i]) for i in order) for row in data), key=repr)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())
