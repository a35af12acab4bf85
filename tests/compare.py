"""Run registered queries beside their SQL: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(columns, rows):
    """Columns by name, rows sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def differences(spark_df, con, statement: str) -> list[str]:
    found = con.execute(statement)
    kinds = {d[0]: str(d[1]) for d in found.description}
    names, want = rows_of([d[0] for d in found.description], found.fetchall())
    got_names, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if names != got_names:
        return [f"columns {got_names} instead of {names}"]
    problems = []
    expected = {"string": "VARCHAR|STRING", "bigint": "BIGINT|NUMBER", "int": "INTEGER|NUMBER", "double": "DOUBLE|NUMBER", "boolean": "BOOLEAN|bool"}
    for name, kind in spark_df.dtypes:
        if kinds[name] not in expected.get(kind, "").split("|"):
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    if len(want) != len(got):
        problems.append(f"{len(got)} rows instead of {len(want)}")
    wrong = [(g, w) for g, w in zip(got, want) if not _same(g, w)]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    if not want:
        problems.append("no rows to compare")
    return problems


def _same(a, b) -> bool:
    return all(
        math.isclose(x, y, rel_tol=0, abs_tol=1e-9) if isinstance(x, float) and y is not None else x == y
        for x, y in zip(a, b)
    )


def main() -> None:
    from conftest import build_session

    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = build_session(), database(sf_dir)
    queries, statements = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in statements:
                problems = differences(df, con, statements[name])
            else:
                problems = [] if df.count() else ["no rows"]
                print("   (rows only)", end="")
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - start:.1f}s", *problems, flush=True)
    print(f"{bad} bad, {len(set(queries) - set(statements))} without SQL")


if __name__ == "__main__":
    main()
