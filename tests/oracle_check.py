"""Run every registered query against its DuckDB oracle, the way the round
driver does: row count, column names, order-insensitive value hash.

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def frame_digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def check(spark, sf_dir: str, keys: list[str] | None = None, verbose: bool = True) -> dict:
    import __spark_entry__ as E
    qs, oracles = E.queries(), E.oracle_sql()
    con = duck_connection(sf_dir)
    results = {}
    for k in (keys or list(qs)):
        t0 = time.time()
        rec = {"oracle": k in oracles}
        try:
            df = qs[k](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
            rec.update(rows=len(rows), seconds=round(time.time() - t0, 2))
            if k in oracles:
                cur = con.execute(oracles[k])
                ocols = [d[0] for d in cur.description]
                orows = cur.fetchall()
                rec["rows_match"] = len(orows) == len(rows)
                rec["cols_match"] = sorted(ocols) == sorted(cols)
                rec["hash_match"] = frame_digest(cols, rows) == frame_digest(ocols, orows)
                if not rec["cols_match"]:
                    rec["cols"] = (sorted(set(cols) - set(ocols)), sorted(set(ocols) - set(cols)))
                if not rec["rows_match"]:
                    rec["oracle_rows"] = len(orows)
        except Exception as e:  # noqa: BLE001 - report and go on
            rec["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        results[k] = rec
        if verbose:
            print(k, rec, flush=True)
    return results


if __name__ == "__main__":
    from weekmart.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_session()
    res = check(spark, sf, keys)
    bad = {k: v for k, v in res.items()
           if "error" in v or (v["oracle"] and not (v["rows_match"] and v["cols_match"] and v["hash_match"]))}
    print(f"{len(res) - len(bad)}/{len(res)} ok; failing: {sorted(bad)}")
