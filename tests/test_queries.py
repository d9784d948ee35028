"""Registered queries equal their SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
CHOSEN = ["a2_a9_line_envelopes", "b1_normalize", "c1_c4_redaction", "d3_d4_command_rollups", "e2_attention", "e7_timeline", "g1_summaries",
          "h2_h6_sealed_batches", "h13_frontier"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("events", "documents", "conversations"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    cols = ", ".join(f'"{c}"' for c in sorted(df.columns))
    plain = lambda rows: sorted(str(tuple(getattr(v, "replace", lambda **k: v)(tzinfo=None) if hasattr(v, "tzinfo") else v for v in r)) for r in rows)
    assert plain(df.select(*sorted(df.columns)).collect()) == plain(con.sql(f"select {cols} from ({entry.oracle_sql()[name]})").fetchall())
