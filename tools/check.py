"""Run registered queries against their SQL in DuckDB: python tools/check.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from abacist.queries import ORACLES, QUERIES  # noqa: E402
from abacist.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def database(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    """Same columns, types and rows, whatever their order."""
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    mine = Counter(tuple(cell(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    if name not in ORACLES:
        return sum(mine.values()) > 0, f"{sum(mine.values())} rows, no SQL"
    rel = con.sql(ORACLES[name])
    if sorted(rel.columns) != cols:
        return False, f"columns {cols} != {sorted(rel.columns)}"
    types = dict(zip(rel.columns, map(str, rel.types)))
    known = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "float": "FLOAT",
    }
    wrong = [f"{c}: {t} != {types[c]}" for c, t in df.dtypes if known.get(t) != types[c]]
    if wrong:
        return False, "types " + "; ".join(wrong)
    theirs = Counter(tuple(cell(v) for v in r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall())
    if mine != theirs:
        key = lambda r: tuple(str(v) for v in r)
        a, b = sorted(mine - theirs, key=key)[:3], sorted(theirs - mine, key=key)[:3]
        return False, f"rows {sum(mine.values())} vs {sum(theirs.values())}; only ours {a}; only SQL {b}"
    return True, f"{sum(mine.values())} rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001  report and go on to the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main()))
