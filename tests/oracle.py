"""Compare a Spark query with its SQL statement run by DuckDB on the same files."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    text = {c: frame[c].map(lambda v: "∅" if v is None or v is pd.NA or v is pd.NaT or v != v else str(v)) for c in frame.columns}
    return pd.DataFrame(text).sort_values(list(frame.columns)).reset_index(drop=True)


def _types(schema) -> dict[str, str]:
    small = {"large_string": "string", "timestamp[ns]": "timestamp[us]"}
    return {f.name: small.get(str(f.type), str(f.type)) for f in schema}


def difference(spark, build, sql: str, sf_dir: str) -> str | None:
    """None when names, types, row count and all values agree, else what differs."""
    ours = build(spark, sf_dir).toArrow()
    con = connect(sf_dir)
    theirs = con.sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} vs {sorted(theirs.column_names)}"
    ours_types, theirs_types = _types(ours.schema), _types(theirs.schema)
    wrong = {c: (ours_types[c], theirs_types[c]) for c in ours_types if ours_types[c] != theirs_types[c]}
    if wrong:
        return f"types {wrong}"
    if ours.num_rows != theirs.num_rows:
        return f"rows {ours.num_rows} vs {theirs.num_rows}"
    if ours.num_rows == 0:
        return "no rows on either side"
    a, b = _plain(ours.to_pandas(types_mapper=pd.ArrowDtype)), _plain(theirs.to_pandas(types_mapper=pd.ArrowDtype))
    if a.equals(b):
        return None
    at = (a != b).any(axis=1)
    return f"{int(at.sum())} rows differ, first:\n{a[at].head(3).to_string()}\nvs\n{b[at].head(3).to_string()}"
