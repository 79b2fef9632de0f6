"""Run every query in Spark and its SQL twin in DuckDB, and compare the rows."""

import glob
import os
import sys
import time
from collections import Counter

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string"}


def compare(df, con, sql):
    """None if both agree, else what differs."""
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    ours = dict(df.dtypes)
    if set(ours) != set(described):
        return f"columns {sorted(ours)} / {sorted(described)}"
    kinds = {c: (ours[c], described[c]) for c in ours if KINDS.get(described[c]) != ours[c]}
    if kinds:
        return f"types {kinds}"
    names = sorted(ours)
    got = Counter(tuple(r) for r in df.select(*names).collect())
    quoted = ", ".join(f'"{n}"' for n in names)
    want = Counter(con.execute(f"SELECT {quoted} FROM ({sql})").fetchall())
    if got != want:
        return f"rows {sum(got.values())} / {sum(want.values())}, only ours {list((got - want).items())[:3]}, only theirs {list((want - got).items())[:3]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from clickloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    bad = 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            verdict = compare(run(spark, sf_dir), con, entry.oracle_sql()[name])
        except Exception as e:  # report and go on to the next query
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        bad += verdict is not None
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.time() - start:.2f}s {verdict or ''}", flush=True)
    print("failed:", bad)
