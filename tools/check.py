"""Run registered queries next to their SQL and report every difference.

    python tools/check.py /root/testdata/sf0.01 [name-prefix ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lexiframe import queries as registry  # noqa: E402
from lexiframe.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def ordered(rows, names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str:
    mine = ordered([tuple(r) for r in df.collect()], df.columns)
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    theirs = ordered(res.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(mine)} rows differ, first {str(wrong[0])[:600]}"
    kinds = {type(v) for r in mine for v in r} - {type(None)}, {type(v) for r in theirs for v in r} - {type(None)}
    if kinds[0] != kinds[1]:
        return f"types {kinds}"
    spark_types = dict(df.dtypes)
    duck_types = {d[0]: str(d[1]).lower() for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    pairs = {"int": "integer", "string": "varchar"}
    odd = {c: (t, duck_types[c]) for c, t in spark_types.items() if pairs.get(t, t) != duck_types[c]}
    return f"ok {len(mine)} rows" + (f" TYPES {odd}" if odd else "")


def main() -> int:
    folder, prefixes = sys.argv[1], tuple(sys.argv[2:])
    only = [p for p in prefixes if p.endswith(".")]
    for module in registry.MODULES if not only else [p[:-1] for p in only]:
        registry.import_module(f"lexiframe.queries.{module}")
    prefixes = tuple(p for p in prefixes if not p.endswith("."))
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, fn in registry.QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        begun = time.time()
        try:
            sql = registry.ORACLES.get(name)
            df = fn(spark, folder)
            verdict = compare(df, con, sql) if sql else f"ok {len(df.collect())} rows (no SQL)"
        except Exception as err:  # report and go on with the next query
            verdict = f"ERROR {type(err).__name__}: {str(err)[:900]}"
        bad += not verdict.startswith("ok") or "TYPES" in verdict
        print(f"{name:32s} {time.time() - begun:6.1f}s  {verdict}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
