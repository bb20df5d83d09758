"""Run a catalogue query and its SQL counterpart and compare their rows."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return names, sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return normal([c[0] for c in cur.description], cur.fetchall())
