"""Scans, cursors, batches and excerpts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import cursors
from tidemark.operators.batches import batch_ledger, batches_of, number_rows
from tidemark.operators.preview import first_rows, page
from tidemark.operators.upsert import delete, upsert
from tidemark.sources.ranges import KeyRanges
from workload import sql
from workload.inputs import CHECKPOINTS, EXECUTIONS, NEW_MARKS, as_sql, derive, table

IDENTITY = ["tenant_id", "source_id", "dataset_id"]


def scan_full(spark, sf):
    return table(spark, sf, "orders")


def scan_nested(spark, sf):
    rows = table(spark, sf, "embeddings")
    return rows.select(
        "vec_id", "label", F.size("embedding").alias("width"),
        F.element_at("embedding", 1).alias("first_value"),
        F.element_at("embedding", -1).alias("last_value"),
        F.aggregate(
            F.transform("embedding", lambda x: F.floor(x.cast("double") * 1_000_000)),
            F.lit(0).cast("bigint"), lambda held, x: held + x,
        ).alias("millionths"),
    )


def scan_keyset_batches(spark, sf):
    return number_rows(table(spark, sf, "orders"), "o_orderkey", 1000)


def scan_keyset_ties(spark, sf):
    rows = table(spark, sf, "lineitem")
    order = ["l_linenumber", "l_extendedprice", "l_quantity", "l_tax", "l_discount", "l_shipdate"]
    return number_rows(rows, "l_orderkey", 1000, order)


def _shares(spark, sf, name, column, shares):
    """Bounds and rows of the ranges that a read of a table by ``column`` would be laid out in.

    Spark stands in for the source: it runs the queries that would go there.
    """
    rows = table(spark, sf, name)
    view = f"source_{name}_{column}"
    rows.createOrReplaceTempView(view)
    ranges = KeyRanges(
        lambda query: spark.sql(query).collect(), "mysql", view, f"`{column}`",
        rows.schema[column].dataType, tolerance=0,
    ).predicates(shares)
    share = F.coalesce(*(F.when(F.expr(p), F.lit(n)) for n, p in enumerate(ranges)))
    return rows.groupBy(share.alias("share")).agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.count(F.lit(1)).alias("held")
    )


def key_ranges(spark, sf):
    return _shares(spark, sf, "lineitem", "l_orderkey", 16)


def key_ranges_moments(spark, sf):
    return _shares(spark, sf, "events", "ts", 24)


def key_ranges_text(spark, sf):
    return _shares(spark, sf, "customer", "c_name", 10)


def _shares_sql(name, column, shares):
    return f"""
    WITH keys AS (SELECT {column} AS k, count(*) AS c FROM {name} GROUP BY 1),
    placed AS (SELECT *, sum(c) OVER (ORDER BY k) - c AS before, sum(c) OVER () AS total FROM keys),
    edges AS (SELECT DISTINCT (SELECT min(k) FROM placed WHERE before * {shares} >= i * total) AS edge
              FROM range(1, {shares}) AS numbers(i))
    SELECT cast(share AS integer) AS share, min(k) AS low, max(k) AS high,
           cast(sum(c) AS bigint) AS held
    FROM (SELECT k, c, (SELECT count(*) FROM edges WHERE edge <= k) AS share FROM keys)
    GROUP BY share
    """


def incremental_by_date(spark, sf):
    return cursors.newer_than(table(spark, sf, "events"), "ts", "2024-01-20T00:00:00Z")


def incremental_by_date_ties(spark, sf):
    return cursors.newer_than(table(spark, sf, "orders"), "o_orderdate", None)


def incremental_by_key(spark, sf):
    return cursors.newer_than(table(spark, sf, "orders"), "O_ORDERKEY", "10000")


def incremental_lookback(spark, sf):
    day = 86400
    return cursors.newer_than(
        table(spark, sf, "lineitem"), "l_shipdate", "2000-01-01T00:00:00Z", lookback=30 * day
    )


def next_checkpoint(spark, sf):
    marks = [
        ("events", "ts"), ("orders", "o_orderdate"), ("orders", "o_orderkey"),
        ("lineitem", "l_shipdate"), ("customer", "c_name"),
    ]
    frames = [
        cursors.high_water_mark(table(spark, sf, name), column).select(
            F.lit(name).alias("dataset_id"), F.lit(column).alias("cursor_column"), "last_value"
        )
        for name, column in marks
    ]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def checkpoint_changed(spark, sf):
    old = derive(spark, sf, CHECKPOINTS).withColumnRenamed("last_value", "old_value")
    new = derive(spark, sf, NEW_MARKS)
    save = cursors.should_save(F.col("last_value"), F.col("old_value"))
    return new.join(old, IDENTITY, "left").where(save).select(*IDENTITY, "last_value")


def checkpoint_upsert(spark, sf):
    old = derive(spark, sf, CHECKPOINTS).withColumn("run", F.lit(1))
    new = derive(spark, sf, NEW_MARKS).where("last_value IS NOT NULL").withColumn("run", F.lit(2))
    return upsert(old, new, IDENTITY, ["run"])


def checkpoint_reset(spark, sf):
    gone = derive(spark, sf, EXECUTIONS).where(F.col("trigger_type") == "scheduled").where(
        F.col("status") == "failed"
    )
    return delete(derive(spark, sf, NEW_MARKS), gone, IDENTITY)


def batch_ledger_by_key(spark, sf):
    return batch_ledger(table(spark, sf, "events"), "event_id", 1000)


def batch_ledger_ties(spark, sf):
    return batch_ledger(table(spark, sf, "orders"), "o_orderdate", 500, ["o_orderkey"])


def batch_sizes(spark, sf):
    return batches_of(derive(spark, sf, EXECUTIONS)).select(
        "execution_id", "batch_number", "records_in_batch"
    )


def preview_first(spark, sf):
    return first_rows(table(spark, sf, "orders"), "o_orderkey", 100)


def preview_page(spark, sf):
    return page(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
                .select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line")),
                "line", 100, 250)


_NUMBERED = "cast(floor((row_number() OVER (ORDER BY {order}) - 1) / {size}) AS bigint) + 1"

QUERIES = {
    "scan_full": (scan_full, "SELECT * FROM orders"),
    "scan_nested": (
        scan_nested,
        "SELECT vec_id, label, cast(len(embedding) AS integer) AS width, "
        "embedding[1] AS first_value, embedding[-1] AS last_value, "
        "cast(list_sum(list_transform(embedding, lambda x: "
        "cast(floor(cast(x AS double) * 1000000) AS bigint))) AS bigint) AS millionths "
        "FROM embeddings",
    ),
    "scan_keyset_batches": (
        scan_keyset_batches,
        f"SELECT *, {_NUMBERED.format(order='o_orderkey', size=1000)} AS batch_number FROM orders",
    ),
    "scan_keyset_ties": (
        scan_keyset_ties,
        "SELECT *, "
        + _NUMBERED.format(
            order="l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_tax, l_discount, "
            "l_shipdate",
            size=1000,
        )
        + " AS batch_number FROM lineitem",
    ),
    "key_ranges": (key_ranges, _shares_sql("lineitem", "l_orderkey", 16)),
    "key_ranges_moments": (key_ranges_moments, _shares_sql("events", "ts", 24)),
    "key_ranges_text": (key_ranges_text, _shares_sql("customer", "c_name", 10)),
    "incremental_by_date": (
        incremental_by_date,
        "SELECT * FROM events WHERE ts > timestamp '2024-01-20 00:00:00'",
    ),
    "incremental_by_date_ties": (incremental_by_date_ties, "SELECT * FROM orders"),
    "incremental_by_key": (incremental_by_key, "SELECT * FROM orders WHERE o_orderkey > 10000"),
    "incremental_lookback": (
        incremental_lookback,
        "SELECT * FROM lineitem WHERE l_shipdate > timestamp '1999-12-02 00:00:00'",
    ),
    "next_checkpoint": (
        next_checkpoint,
        f"""
        SELECT 'events' AS dataset_id, 'ts' AS cursor_column, {sql.utc('max(ts)')} AS last_value
        FROM events UNION ALL
        SELECT 'orders', 'o_orderdate', {sql.utc('max(o_orderdate)')} FROM orders UNION ALL
        SELECT 'orders', 'o_orderkey', cast(max(o_orderkey) AS varchar) FROM orders UNION ALL
        SELECT 'lineitem', 'l_shipdate', {sql.utc('max(l_shipdate)')} FROM lineitem UNION ALL
        SELECT 'customer', 'c_name', max(c_name) FROM customer
        """,
    ),
    "checkpoint_changed": (
        checkpoint_changed,
        f"""
        SELECT n.tenant_id, n.source_id, n.dataset_id, n.last_value
        FROM {as_sql(NEW_MARKS)} n
        LEFT JOIN {as_sql(CHECKPOINTS)} o USING (tenant_id, source_id, dataset_id)
        WHERE n.last_value IS NOT NULL AND n.last_value <> ''
          AND n.last_value IS DISTINCT FROM o.last_value
        """,
    ),
    "checkpoint_upsert": (
        checkpoint_upsert,
        f"""
        SELECT coalesce(n.tenant_id, o.tenant_id) AS tenant_id,
               coalesce(n.source_id, o.source_id) AS source_id,
               coalesce(n.dataset_id, o.dataset_id) AS dataset_id,
               coalesce(n.last_value, o.last_value) AS last_value,
               cast(CASE WHEN n.last_value IS NULL THEN 1 ELSE 2 END AS integer) AS run
        FROM {as_sql(CHECKPOINTS)} o
        FULL JOIN (SELECT * FROM {as_sql(NEW_MARKS)} m WHERE last_value IS NOT NULL) n
          USING (tenant_id, source_id, dataset_id)
        """,
    ),
    "checkpoint_reset": (
        checkpoint_reset,
        f"""
        SELECT * FROM {as_sql(NEW_MARKS)} m WHERE NOT EXISTS (
            SELECT 1 FROM {as_sql(EXECUTIONS)} e
            WHERE e.trigger_type = 'scheduled' AND e.status = 'failed'
              AND e.tenant_id = m.tenant_id AND e.source_id = m.source_id
              AND e.dataset_id = m.dataset_id)
        """,
    ),
    "batch_ledger": (
        batch_ledger_by_key,
        f"""
        SELECT batch_number, count(*) AS records_in_batch, min(event_id) AS first_key,
               max(event_id) AS last_key
        FROM (SELECT event_id, {_NUMBERED.format(order='event_id', size=1000)} AS batch_number
              FROM events) GROUP BY batch_number
        """,
    ),
    "batch_ledger_ties": (
        batch_ledger_ties,
        f"""
        SELECT batch_number, count(*) AS records_in_batch, min(o_orderdate) AS first_key,
               max(o_orderdate) AS last_key
        FROM (SELECT o_orderdate,
                     {_NUMBERED.format(order='o_orderdate, o_orderkey', size=500)} AS batch_number
              FROM orders) GROUP BY batch_number
        """,
    ),
    "batch_sizes": (
        batch_sizes,
        f"""
        SELECT execution_id, batch_number,
               least(size, total_records - (batch_number - 1) * size) AS records_in_batch
        FROM (SELECT execution_id, total_records, size, unnest(range(
                         1, cast((total_records + size - 1) // size AS bigint) + 1)) AS batch_number
              FROM (SELECT *, cast(CASE WHEN batch_size > 0 THEN batch_size ELSE 1000 END
                                   AS bigint) AS size
                    FROM {as_sql(EXECUTIONS)} e WHERE total_records > 0))
        """,
    ),
    "preview_first": (preview_first, "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100"),
    "preview_page": (
        preview_page,
        "SELECT line FROM (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS line FROM lineitem)"
        " ORDER BY line LIMIT 100 OFFSET 250",
    ),
}
