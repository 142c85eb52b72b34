"""Runs registered queries and their oracle SQL side by side.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


_FAMILY = {
    "tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "bigint",
    "varchar": "string", "timestamp_ntz": "timestamp", "float": "float",
}


def _kind(name: str) -> str:
    name = name.lower()
    return _FAMILY.get(name, name)


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[int, list[str]]:
    """Row count and a list of differences in schema or values, whatever the row order."""
    frame = query(spark, sf_dir)
    names = sorted(frame.columns)
    kinds = {f.name: _kind(f.dataType.simpleString()) for f in frame.schema.fields}
    problems = []
    described = con.execute(f"describe {sql}").fetchall()
    duck_kinds = {row[0]: _kind(row[1]) for row in described}
    if kinds != duck_kinds:
        odd = {n for n in kinds.keys() | duck_kinds.keys() if kinds.get(n) != duck_kinds.get(n)}
        problems.append("schema " + str({n: (kinds.get(n), duck_kinds.get(n)) for n in odd}))
    if set(kinds) == set(duck_kinds):
        ours = Counter(tuple(row) for row in frame.select(*names).collect())
        columns = ", ".join(f'"{n}"' for n in names)
        theirs = Counter(con.execute(f"select {columns} from ({sql})").fetchall())
        if ours != theirs:
            more, less = list((ours - theirs).items()), list((theirs - ours).items())
            problems.append(f"values: {len(more)} only here {more[:2]}, {len(less)} only there {less[:2]}")
        return sum(ours.values()), problems
    return frame.count(), problems


def main() -> int:
    from opdiag.session import build_session
    from __spark_entry__ import oracle_sql, queries

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con, failed = build_session("compare", cores=8), duck(sf_dir), 0
    sqls = oracle_sql()
    for name, query in queries().items():
        if args and name not in args:
            continue
        started = time.time()
        try:
            if name in sqls:
                rows, problems = compare(spark, con, query, sqls[name], sf_dir)
            else:
                rows, problems = query(spark, sf_dir).count(), ["no oracle"]
        except Exception as error:  # report and go on with the other queries
            rows, problems = -1, [str(error)[:600]]
        failed += bool(problems) and problems != ["no oracle"]
        print(f"{name:32s} rows={rows:<8d} {time.time() - started:5.1f}s {problems or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
