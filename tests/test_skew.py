"""The same queries where one key holds a third of all rows, and rows come as copies and ties."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from chartfold.contracts import VITALS
from chartfold.operators.history import chain_distinct
from chartfold.plans.oracles import ORACLES
from oracle import compare, connect

SOURCE = "/root/testdata/sf0.001"
SKEWED = {
    "events": """
        WITH hot AS (
          SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id) FROM src)
        SELECT * FROM hot
        UNION ALL SELECT * FROM hot WHERE event_id % 3 = 0
        UNION ALL SELECT * REPLACE (value + 1 AS value, 'error' AS event_type)
                  FROM hot WHERE event_id % 5 = 0""",
    "orders": """
        WITH hot AS (
          SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey,
            CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1995-03-05' ELSE o_orderdate END AS o_orderdate,
            CASE WHEN o_orderkey % 3 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus) FROM src)
        SELECT * FROM hot UNION ALL SELECT * FROM hot WHERE o_orderkey % 4 = 0""",
    "customer": "SELECT * FROM src UNION ALL SELECT * FROM src WHERE c_custkey % 3 = 0",
}
PLAIN = ("supplier", "nation", "documents")


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in (*SKEWED, *PLAIN):
        con = duckdb.connect()
        con.sql(f"CREATE VIEW src AS SELECT * FROM '{Path(SOURCE) / name}.parquet'")
        rows = SKEWED.get(name, "SELECT * FROM src")
        con.sql(f"COPY ({rows}) TO '{folder / name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, skewed, name):
    compare(driver.queries()[name](spark, skewed), ORACLES[name], connect(skewed))


def test_keys_with_few_and_with_many_arrivals_chain_alike(spark):
    rows = spark.range(0, 3_000, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 97 = 0 THEN NULL ELSE concat('E', id % 40) END AS encounter_id",
        "'p' AS hashed_patient_id", "id AS heart_rate", "'b' AS blood_pressure", "1.0D AS temperature",
        "'v' AS source_vendor", "'u' AS lineage_file_uuid",
        "CAST(timestamp_micros(1700000000000000 + id * 40000) AS timestamp_ntz) AS ingested_at")
    chained = [sorted(map(str, chain_distinct(rows, VITALS, hot).collect())) for hot in (10_000, 500, 0)]
    assert chained[0] == chained[1] == chained[2]
    by_key = {}
    for r in sorted(chain_distinct(rows, VITALS, 500).collect(), key=lambda r: r.start_time):
        before = by_key.get(r.encounter_id)
        assert before is None or before.end_time == r.start_time
        by_key[r.encounter_id] = r
    assert all(r.is_current for r in by_key.values())
