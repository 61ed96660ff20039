"""Compare a registered query with its SQL on DuckDB."""

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(spark, sf_dir, con, query, sql):
    """Column names and counted rows that differ; empty when the results agree."""
    got = query(spark, sf_dir)
    names = sorted(got.columns)
    result = con.execute(sql)
    expected_names = [d[0] for d in result.description]
    if sorted(expected_names) != names:
        return {"columns": (sorted(expected_names), names)}
    order = [expected_names.index(n) for n in names]
    expected = sorted((repr([row[i] for i in order]) for row in result.fetchall()))
    rows = sorted(repr([row[n] for n in names]) for row in got.collect())
    if rows == expected:
        return {} if rows else {"empty": True}
    extra, missing = set(rows) - set(expected), set(expected) - set(rows)
    return {"rows": (len(rows), len(expected)), "extra": sorted(extra)[:3],
            "missing": sorted(missing)[:3]}
