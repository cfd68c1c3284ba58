"""Run registered queries in Spark and their oracle SQL in DuckDB; compare like the driver does.

usage: python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from feedlens.plans import CHECK, ORACLE, QUERIES  # noqa: E402
from feedlens.plans.fixtures import BASE_TABLES  # noqa: E402
from feedlens.session import local_session  # noqa: E402


from feedlens.plans.compare import compare  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or sorted(QUERIES)
    spark = local_session()
    if os.environ.get("CHECK_ANSI") in ("0", "false"):
        spark.conf.set("spark.sql.ansi.enabled", "false")
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            srows = df.collect()
            scols = df.columns
            stypes = [f.dataType.simpleString() for f in df.schema.fields]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {e!r}"[:2000])
            traceback.print_exc(limit=3)
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLE:
            print(f"R    {name}: {len(srows)} rows ({ts:.1f}s) cols={scols}")
            ok += 1
            continue
        try:
            cur = con.execute(ORACLE[name])
            dcols = [d[0] for d in cur.description]
            dtypes = [str(d[1]) for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {e!r}"[:2000])
            bad += 1
            continue
        problems = compare(scols, srows, dcols, drows)
        st = dict(zip(scols, stypes))
        dt = dict(zip(dcols, dtypes))
        types = " ".join(f"{c}:{st.get(c)}/{dt.get(c)}" for c in sorted(scols))
        if problems:
            bad += 1
            print(f"FAIL {name} ({ts:.1f}s): " + "; ".join(problems)[:3000])
            print(f"     types {types}")
        else:
            ok += 1
            print(f"OK   {name}: {len(srows)} rows ({ts:.1f}s) [{CHECK[name]}]")
            simple = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                      "boolean": "BOOLEAN"}
            for c in sorted(scols):
                if simple.get(st.get(c)) != dt.get(c):
                    print(f"TYPE {name}.{c}: spark {st.get(c)} vs oracle {dt.get(c)}")
    print(f"\n{ok} ok, {bad} failed of {len(names)}")


if __name__ == "__main__":
    main()
