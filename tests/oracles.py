"""Run registered queries in Spark and their SQL oracles in DuckDB; compare
row count, column names and an order-insensitive hash of the values."""
from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass

from pyspark.sql import SparkSession

from regloom.plans.registry import all_queries
from regloom.sources.tables import TABLE_NAMES


def _norm(v) -> str:
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[str, list[str]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


@dataclass
class Outcome:
    name: str
    ok: bool
    rows: int
    seconds: float
    message: str = ""


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> list[Outcome]:
    con = duck_connection(sf_dir)
    out = []
    for name, q in all_queries().items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            out.append(Outcome(name, False, 0, time.time() - t0, f"spark error {type(e).__name__}: {str(e)[:300]}"))
            continue
        secs = time.time() - t0
        if not q.oracle:
            out.append(Outcome(name, True, len(rows), secs, "no oracle"))
            continue
        try:
            res = con.execute(q.oracle)
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            out.append(Outcome(name, False, len(rows), secs, f"duckdb error {str(e)[:300]}"))
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        if sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2:
            out.append(Outcome(name, True, len(rows), secs))
        else:
            s1, s2 = set(l1), set(l2)
            msg = (
                f"spark {len(rows)} rows {sorted(cols)} vs duck {len(orows)} rows {sorted(ocols)}; "
                f"spark-only {sorted(s1 - s2)[:2]} duck-only {sorted(s2 - s1)[:2]}"
            )
            out.append(Outcome(name, False, len(rows), secs, msg[:1500]))
    return out
