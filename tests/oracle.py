"""Compare a query with its reference SQL in DuckDB: names, types, rows."""

import duckdb
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_TYPES = {
    T.StringType(): "VARCHAR",
    T.LongType(): "BIGINT",
    T.IntegerType(): "INTEGER",
    T.DoubleType(): "DOUBLE",
    T.BooleanType(): "BOOLEAN",
}


def sql_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    return _TYPES[kind]


def expected(sql: str, sf_dir: str):
    """Column types by name, and the sorted rows, columns in order of name."""
    with duckdb.connect() as con:
        for name in TABLES:
            con.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
        types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
        names = ", ".join(sorted(types))
        rows = con.execute(f"SELECT {names} FROM ({sql})").fetchall()
    return types, sorted(rows, key=repr)


def actual(df):
    types = {f.name: sql_type(f.dataType) for f in df.schema}
    rows = [tuple(r) for r in df.select(*sorted(types)).collect()]
    return types, sorted(rows, key=repr)
