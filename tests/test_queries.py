"""Registered queries over sf0.001 against their SQL: those of sources, sinks, requests, reports and packing."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from glossometer.jobs import registry

SF = "/root/testdata/sf0.001"
NAMES = ("s1_hour_index", "s2_hour_states", "s3_file_ledger", "s4_quoted_lines", "j3_hot_keys", "a4_ratings_of_any_total", "e2_compare_months", "s3_read_events", "s4_read_archive", "s4_bad_rows", "s5_write_archive", "s7_write_languages", "s8_write_ratings", "s9_read_rating_files", "k1_pack_ratings", "k2_pack_all", "x4_slug_counts", "x6_metric_names", "g1_numbered_requests", "g1_request_texts", "a9_filter_report", "a9_filter_report_by_month", "fc_filter_months")


@pytest.mark.parametrize("name", NAMES)
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "events", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    there = con.execute(registry.ORACLES[name])
    columns = [c[0] for c in there.description]
    flat = lambda row: tuple(round(x, 9) if isinstance(x, float) else x for x in row)
    got = registry.QUERIES[name](spark, SF)
    assert set(got.columns) == set(columns)
    assert Counter(flat(r) for r in got.select(*columns).collect()) == Counter(flat(r) for r in there.fetchall())


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
