import datetime

import pytest

from tidemark.operators.envelope import log_rows, normalized_records, raw_records

AT = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
IDENTITY = {"tenant_id": "t", "source_id": "s", "dataset_id": "d", "execution_id": "e"}

TABLES = {
    "texts": "SELECT explode(array(' a', 'b', NULL, 'c ', '<&>', ' <')) AS t, 1 AS n",
    "names": "SELECT ' a' AS ` T `, id AS N FROM range(3)",
    "bytes": "SELECT X'2041' AS b, 'x' AS t",
    "numbers": "SELECT id, id * 0.5D AS d, id % 2 = 0 AS f FROM range(5)",
    "moments": "SELECT timestamp_ntz '2024-01-02 03:04:05.5' AS at, 'x ' AS t",
    "taken names": "SELECT id AS raw_json, 'x ' AS normal_json, id AS raw_hash FROM range(3)",
    "null keys": "SELECT if(id % 2 = 0, NULL, concat(' k', id)) AS t, 'v' AS v FROM range(6)",
}


@pytest.mark.parametrize("technical_key", [None, "t", "id", "absent"])
@pytest.mark.parametrize("table", TABLES)
def test_log_rows_agree_with_both_layers(spark, table, technical_key):
    rows = spark.sql(TABLES[table])
    log = log_rows(rows, technical_key)
    for layer, records in (("raw", raw_records), ("normalized", normalized_records)):
        want = records(rows, IDENTITY, AT, technical_key).select("record_key", "payload")
        got = log.select(f"{layer}_key", f"{layer}_payload")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_one_narrow_stage(spark, testdata):
    rows = spark.read.parquet(f"{testdata}/lineitem.parquet")
    plan = log_rows(rows, "l_orderkey", "l_shipdate")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("*(1)") >= 3 and "*(2)" not in plan
