"""Run registered queries and their DuckDB oracles side by side.

    python -m tests.oracle_harness /root/testdata/sf0.01 [name ...]

Compares column names, row count and the multiset of rows (Arrow values,
order-insensitive), the same checks the driver makes.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, 9)
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(table):
    cols = sorted(table.column_names)
    data = table.select(cols).to_pylist()
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in data), key=repr)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    st = sdf.toArrow()
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    res = {"name": name, "spark_rows": st.num_rows, "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    ot = con.sql(sql).to_arrow_table()
    res["oracle_rows"] = ot.num_rows
    scols, srows = rows_of(st)
    ocols, orows = rows_of(ot)
    if scols != ocols:
        res["status"] = f"COLUMNS spark={scols} oracle={ocols}"
        return res
    stypes = {f.name: str(f.type) for f in st.schema}
    otypes = {f.name: str(f.type) for f in ot.schema}
    tdiff = {c: (stypes[c], otypes[c]) for c in scols if stypes[c] != otypes[c]}
    if len(srows) != len(orows):
        res["status"] = "ROWCOUNT"
    elif srows != orows:
        bad = [(a, b) for a, b in zip(srows, orows) if a != b]
        res["status"] = f"VALUES {len(bad)} differ; first: {bad[:2]}"
    else:
        res["status"] = "ok"
    if tdiff:
        res["types"] = tdiff
    return res


def main(argv):
    sys.path.insert(0, ".")
    from meterline.session import build_session
    import __spark_entry__ as E
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(E.queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        ok = r["status"] in ("ok", "no-oracle") and not r.get("types")
        bad += not ok
        print(("  " if ok else "XX"), r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])
