"""Runs registered queries beside their SQL counterparts; used by the tests and by hand."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def expected(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for name in TABLES:
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
        result = db.execute(sql)
        return [c[0] for c in result.description], result.fetchall()


def comparable(columns: list[str], rows: list) -> list[tuple]:
    """Rows with columns in name order, sorted, with floats rounded alike."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v: object) -> object:
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, query, sql: str, sf_dir: str) -> str:
    """Empty when Spark and SQL agree."""
    df = query(spark, sf_dir)
    columns, rows = expected(sql, sf_dir)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    ours, theirs = comparable(df.columns, df.collect()), comparable(columns, rows)
    if not theirs:
        return "the expected result is empty"
    if ours == theirs:
        return ""
    only_ours = [r for r in ours if r not in set(theirs)][:2]
    only_theirs = [r for r in theirs if r not in set(ours)][:2]
    return f"{len(ours)} rows, {len(theirs)} expected; ours {only_ours}; expected {only_theirs}"


def main(sf: str, *names: str) -> None:
    from __spark_entry__ import oracle_sql, queries
    from stallkeeper.session import local_session

    spark, sf_dir = local_session(8), f"/root/testdata/{sf}"
    oracles = oracle_sql()
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            if name in oracles:
                verdict = difference(spark, query, oracles[name], sf_dir) or "same"
            else:
                verdict = f"{len(query(spark, sf_dir).collect())} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            verdict = f"FAILED {str(error)[:1500]}"
        print(f"@@ {name} {time.time() - started:.1f}s {verdict}", flush=True)


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    main(*sys.argv[1:])
