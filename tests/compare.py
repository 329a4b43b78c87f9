"""Run a registered query and its check SQL side by side."""

import glob
import math
import os
from collections import Counter
from datetime import datetime

import duckdb


def open_tables(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value) if value is not None else None


def _kind(name: str) -> str:
    """Type names of both engines in common words."""
    name = name.lower()
    same = {
        "string": "text", "varchar": "text", "int": "integer", "int32": "integer",
        "timestamp_ntz": "timestamp", "bool": "boolean", "float64": "double",
    }
    return same.get(name, name)


def compare(spark, con, run, sql: str, sf_dir: str) -> list[str]:
    """Differences in columns, types and rows (as multisets); empty when equal."""
    frame = run(spark, sf_dir)
    names = sorted(frame.columns)
    got = Counter(tuple(_plain(r[c]) for c in names) for r in frame.collect())
    answer = con.execute(sql)
    have = [d[0] for d in answer.description]
    rows = answer.fetchall()
    problems = []
    if sorted(have) != names:
        return [f"columns {names} != {sorted(have)}"]
    kinds = {d[0]: _kind(str(d[1])) for d in answer.description}
    mine = {n: _kind(t) for n, t in frame.dtypes}
    problems += [f"type of {n}: {mine[n]} / {kinds[n]}" for n in names if mine[n] != kinds[n]]
    place = [have.index(c) for c in names]
    want = Counter(tuple(_plain(r[i]) for i in place) for r in rows)
    if got != want:
        problems.append(
            f"rows {sum(got.values())} / {sum(want.values())}; "
            f"only here {list((got - want))[:2]}; only there {list((want - got))[:2]}"
        )
    return problems
