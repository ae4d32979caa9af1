"""Run registered queries beside their SQL statements and compare the row multisets.

    python tests/oracle.py [sf] [query ...]
"""

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
DATA = "/root/testdata"


def connect(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/sf{sf}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


_KIND = {"long": "BIGINT", "integer": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


def compare(spark, con, name, query, sql, sf):
    """(rows, problems) of one query against its statement."""
    df = query(spark, f"{DATA}/sf{sf}")
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    if sql is None:
        return sum(ours.values()), [] if ours else ["no rows"]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    problems = []
    if sorted(names) != columns:
        return sum(ours.values()), [f"columns {columns} vs {sorted(names)}"]
    for f in df.schema.fields:
        want = _KIND.get(f.dataType.typeName())
        if want and kinds[f.name] not in (want, want.replace("VARCHAR", "STRING")):
            problems.append(f"type of {f.name}: {f.dataType.simpleString()} vs {kinds[f.name]}")
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())
    if ours != theirs:
        problems.append(
            f"rows {sum(ours.values())} vs {sum(theirs.values())}; ours only {str(list((ours - theirs).items())[:2])[:500]};"
            f" theirs only {str(list((theirs - ours).items())[:2])[:500]}"
        )
    if not ours:
        problems.append("no rows")
    return sum(ours.values()), problems


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from provenlake.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    session, con = local_session(), connect(sf)
    statements, failed = oracle_sql(), []
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            n, bad = compare(session, con, name, fn, statements.get(name), sf)
        except Exception as exc:  # noqa: BLE001
            n, bad = -1, [f"{type(exc).__name__}: {str(exc)[:600]}"]
        print(f"{'FAIL' if bad else 'ok  '} {name:28s} {n:8d} rows {time.time() - start:6.2f}s {'' if name in statements else '(no sql)'}", *bad)
        failed += [name] if bad else []
    print("failed:", failed)
