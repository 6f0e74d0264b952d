"""Run registered queries next to their SQL and compare whole results.

    python tests/compare.py SF_DIR [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return str([_cell(v) for v in value])
    if isinstance(value, dict):
        return str({k: _cell(v) for k, v in sorted(value.items())})
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


FAMILY = {"tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "bigint", "long": "bigint",
          "varchar": "string", "string": "string", "double": "double", "boolean": "boolean", "float": "float"}


def family(name: str) -> str:
    return FAMILY.get(name.lower(), name.lower())


def compare(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """Differences between the two results; empty when they agree."""
    frame = query(spark, sf_dir)
    mine_columns, mine = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    answer = con.execute(sql)
    described = [(d[0], str(d[1])) for d in answer.description]
    theirs_columns, theirs = canonical([n for n, _ in described], answer.fetchall())
    problems = []
    if mine_columns != theirs_columns:
        return [f"columns {mine_columns} != {theirs_columns}"]
    types = {f.name: family(f.dataType.simpleString()) for f in frame.schema}
    for name, kind in described:
        if "decimal" in kind.lower() or "hugeint" in kind.lower() or types[name] != family(kind):
            problems.append(f"type of {name}: {types[name]} != {kind}")
    if len(mine) != len(theirs):
        problems.append(f"rows {len(mine)} != {len(theirs)}")
    if mine != theirs:
        only_mine = sorted(set(mine) - set(theirs))[:3]
        only_theirs = sorted(set(theirs) - set(mine))[:3]
        problems.append(f"values: mine {only_mine} theirs {only_theirs}")
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as contract
    from caselens.session import build_session

    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles, bad = duck(sf_dir), contract.queries(), contract.oracle_sql(), 0
    for name in names or list(queries):
        began = time.time()
        try:
            if name in oracles:
                problems = compare(spark, con, queries[name], oracles[name], sf_dir)
            else:
                problems = [] if queries[name](spark, sf_dir).collect() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{'ok ' if not problems else 'BAD'} {time.time() - began:6.1f}s {name} {'' if name in oracles else '(rows only)'}", *problems, sep="\n    " if problems else " ", flush=True)
    print(f"{bad} of {len(names or queries)} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
