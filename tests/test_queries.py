"""Registered queries against their SQL on the smallest tables: a spread of families; tools/check.py covers all of them."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, key, norm  # noqa: E402

DIR = "/root/testdata/sf0.001"
NAMES = (
    "splat_activation", "morton_codes", "crop_box", "group_replace", "outlier_filter", "label_votes", "object_summary", "bounds_trimmed",
    "histogram", "input_gate", "reductions", "loss_average", "spline_values", "weighted_draw", "weighted_draw_replace", "knn", "grow_selection",
    "clean_faces", "near_duplicates", "coverage_scores", "asset_upsert", "world_transforms",
)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=key)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    assert got == sorted((tuple(norm(r[i]) for i in idx) for r in cur.fetchall()), key=key)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
