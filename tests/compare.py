"""Row-by-row comparison of a Spark result with DuckDB's."""

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Type families, Spark name to DuckDB names.
FAMILIES = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "string": {"VARCHAR"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def differences(df, con, sql):
    """An empty text when the two results agree, else what differs first."""
    names = sorted(df.columns)
    result = con.sql(sql)
    if sorted(result.columns) != names:
        return f"columns {names} / {sorted(result.columns)}"
    theirs_types = {c: str(t) for c, t in zip(result.columns, result.types)}
    for name in names:
        ours = df.schema[name].dataType.simpleString()
        if theirs_types[name] not in FAMILIES.get(ours, {ours}):
            return f"type of {name}: {ours} / {theirs_types[name]}"
    listed = ", ".join('"' + name + '"' for name in names)
    theirs = _sorted(con.sql(f"SELECT {listed} FROM ({sql})").fetchall())
    ours = _sorted(df.select(*names).collect())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows / {len(theirs)} rows"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{mine} / {other}"
    return ""
