"""Hold registered queries against their SQL twins: python tests/oracle.py [sf_dir] [name prefix...]"""

from __future__ import annotations

import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "as_tuple"):
        return round(float(v), 6) + 0.0
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def differs(df, con, sql: str) -> str | None:
    """None if the query's rows equal the oracle's as a multiset, over columns by name."""
    names = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    if sorted(cols) != names:
        return f"columns {names} and {sorted(cols)}"
    at = [cols.index(c) for c in names]
    want = Counter(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
    if got == want:
        return None
    return f"{sum(got.values())} and {sum(want.values())} rows; only here {list((got - want).items())[:2]}; only there {list((want - got).items())[:2]}"


def main(args: list[str]) -> int:
    from millrace.plans import registry
    from millrace.session import local_session

    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    prefixes = [a for a in args if not a.startswith("/")]
    spark, con, bad = local_session(4), connection(sf), 0
    queries, sql = registry.queries(), registry.oracle_sql()
    for name, f in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        began = time.time()
        try:
            said = differs(f(spark, sf), con, sql[name]) if name in sql else f"no oracle; {f(spark, sf).count()} rows"
        except Exception as e:
            said = f"{type(e).__name__}: {str(e).strip()[:500]}" if "-v" not in args else traceback.format_exc()
        bad += said is not None and name in sql
        print(f"{name} {time.time() - began:.1f}s {said or 'ok'}"[:900], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1:])))
