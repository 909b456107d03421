"""Run a registered query and its SQL twin on the same tables and compare them.

Command line: ``python tests/compare.py FOLDER [name ...]``.
"""

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "as_tuple") or isinstance(value, float):
        return round(float(value), 6) + 0.0
    return value


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in records]
    return [names[i] for i in order], sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


def close(a, b):
    if isinstance(a, float) and isinstance(b, (int, float)) or isinstance(b, float) and isinstance(a, int):
        return abs(a - b) <= 1.5e-6 * max(1.0, abs(a), abs(b))
    return a == b


def difference(df, con, sql):
    """None when equal, else a short description."""
    names, mine = rows(df.columns, df.collect())
    cursor = con.execute(sql)
    other_names, other = rows([d[0] for d in cursor.description], cursor.fetchall())
    if names != other_names:
        return f"columns {names} / {other_names}"
    if len(mine) != len(other):
        return f"rows {len(mine)} / {len(other)}"
    for a, b in zip(mine, other):
        if not all(close(x, y) for x, y in zip(a, b)):
            return f"value {str(a)[:600]} / {str(b)[:600]}"
    return None


def main(folder, names):
    from quotelens.plans.queries import QUERIES, SQL
    from quotelens.session import local_session

    spark, con = local_session(), connect(folder)
    bad = []
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            result = difference(df, con, SQL[name]) if name in SQL else f"(no SQL) {df.count()} rows"
        except Exception as problem:
            result = f"{type(problem).__name__}: {str(problem)[:900]}"
        if result and not result.startswith("(no SQL)"):
            bad.append(name)
        print(f"{name:32s} {time.time() - start:6.2f}s {result or 'ok'}", flush=True)
    print(f"{len(bad)} differ: {bad}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
