"""Side-by-side run of driver queries and their SQL twins."""

import duckdb
import numpy as np
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        kind = frame[c].dtype.kind
        if kind == "M":
            frame[c] = frame[c].astype("datetime64[us]").astype(str)
        elif kind in "iub":
            frame[c] = frame[c].astype("float64")
        elif kind == "O":
            try:
                frame[c] = frame[c].astype("float64")
            except (TypeError, ValueError):
                frame[c] = frame[c].astype(object).where(frame[c].notna(), None).map(
                    lambda v: "<null>" if v is None else str(v))
    frame = frame.replace(-0.0, 0.0)
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame):
    """None when equal as bags of rows with equal column names, else what differs."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    a, b = _canonical(spark_frame), _canonical(sql_frame)
    for c in a.columns:
        if a[c].dtype.kind == "f" and b[c].dtype.kind == "f":
            equal = (a[c].to_numpy() == b[c].to_numpy()) | (
                np.isnan(a[c].to_numpy()) & np.isnan(b[c].to_numpy()))
        else:
            equal = a[c].astype(str).to_numpy() == b[c].astype(str).to_numpy()
        if not equal.all():
            at = int(np.argmin(equal))
            return f"column {c}: {(~equal).sum()} differ, first {a[c][at]!r} / {b[c][at]!r}"
    return None


SIMPLE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
          "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
          "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_difference(spark_frame, relation):
    """Columns whose SQL type is not the twin of the Spark type."""
    sql = dict(zip(relation.columns, map(str, relation.types)))
    return {n: (t, sql.get(n)) for n, t in spark_frame.dtypes if SIMPLE.get(t, t) != sql.get(n)}
