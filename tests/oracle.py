"""Side-by-side comparison of a Spark query with its DuckDB counterpart."""

import duckdb
import pyarrow as pa

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table[n].to_pylist() for n in names]
    return sorted(zip(*columns), key=lambda row: tuple((v is None, str(type(v)), v) for v in row))


def _types(table: pa.Table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def difference(spark_df, con, sql) -> str | None:
    """None where rows, names and types agree, else a short account of the gap."""
    got, want = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    if _types(got) != _types(want):
        return f"types: {_types(got)} != {_types(want)}"
    left, right = _rows(got), _rows(want)
    if len(left) != len(right):
        return f"rows: {len(left)} != {len(right)}"
    gaps = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(gaps)} rows differ, first {gaps[0]}" if gaps else None
