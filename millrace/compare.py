"""Compare a query result with its SQL twin (used by tests and tools only)."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.sql(sql).to_arrow_table()


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr)


def compare(df: DataFrame, sql: str | None, sf_dir: str) -> tuple[str | None, int]:
    """What differs (None if nothing) and the number of rows."""
    mine = df.toArrow()
    if sql is None:
        return None, mine.num_rows
    theirs = oracle(sql, sf_dir)
    if sorted(mine.column_names) != sorted(theirs.column_names):
        return f"columns {mine.column_names} != {theirs.column_names}", mine.num_rows
    kinds = {n: (str(mine.schema.field(n).type), str(theirs.schema.field(n).type)) for n in mine.column_names}
    odd = {n: k for n, k in kinds.items() if k[0].replace("large_", "") != k[1].replace("large_", "")}
    if odd:
        return f"types differ: {odd}", mine.num_rows
    a, b = _rows(mine), _rows(theirs)
    if a == b:
        return None, mine.num_rows
    only_a = [r for r in a if r not in set(b)][:2]
    only_b = [r for r in b if r not in set(a)][:2]
    return f"{len(a)} vs {len(b)} rows; only here {only_a}; only there {only_b}", mine.num_rows
