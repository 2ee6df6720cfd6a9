"""Comparing a DataFrame with the result of its SQL twin."""

from __future__ import annotations

import glob
import os

import duckdb


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    found = con.execute(sql)
    return [d[0] for d in found.description], found.fetchall()


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def assert_matches(df, sf_dir: str, sql: str) -> None:
    columns, rows = canonical(*oracle_rows(sf_dir, sql))
    got_columns, got_rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got_columns == columns
    assert len(got_rows) == len(rows)
    wrong = [(g, w) for g, w in zip(got_rows, rows) if repr(g) != repr(w)]
    assert not wrong, wrong[:3]
