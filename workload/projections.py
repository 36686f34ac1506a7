"""Normalisation, payloads, keys and envelopes."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import keys, payload, values
from tidemark.operators.envelope import normalized_records, raw_records
from workload import sql
from workload.inputs import as_sql, derive, table

AT = datetime.datetime(2024, 6, 1, 12, 0, tzinfo=datetime.timezone.utc)

PADDED = """
SELECT c_custkey AS ` C_CustKey `,
       concat(chr(9), c_name, ' ', chr(160)) AS `C_NAME`,
       concat(chr(10), c_mktsegment, '  ', c_mktsegment, chr(13)) AS `Segment`,
       c_acctbal AS `c_acctbal`
FROM {customer}
"""
PADDED_DUCK = PADDED.replace("`", '"')

KEYED_ORDERS = """
SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS id,
       o_orderkey, o_orderpriority
FROM {orders}
"""


# Doubles of every size: products and quotients are the same in any engine.
SCALED = """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price,
       -l_extendedprice * 1e9D AS large, l_extendedprice * 1e17D AS huge, l_quantity / 3e4D AS small,
       l_tax / 7e6D AS tiny
FROM {lineitem}
"""
NESTED = """
SELECT o_orderkey,
       named_struct('total', o_totalprice, 'customer', named_struct('segment', o_orderpriority,
           'key', o_custkey), 'missing', cast(NULL AS double)) AS deep,
       map(concat('z', o_orderstatus), o_totalprice / 1e9D, 'b', o_totalprice * 1e18D, 'a', NULL) AS parts,
       array(named_struct('status', o_orderstatus, 'half', o_totalprice / 2), NULL) AS list
FROM {orders}
"""


def record_key_hash_doubles(spark, sf):
    rows = derive(spark, sf, SCALED)
    return rows.select(
        "l_orderkey", "l_linenumber", keys.raw_key(rows, None, payload.raw_payload(rows)).alias("record_key")
    )


def raw_payload_nested(spark, sf):
    rows = derive(spark, sf, NESTED)
    return rows.select("o_orderkey", payload.raw_payload(rows).alias("payload"))


def normalized_columns(spark, sf):
    return values.normalized(derive(spark, sf, PADDED))


def normalized_texts(spark, sf):
    return values.normalized(table(spark, sf, "documents"))


def normalized_conversations(spark, sf):
    return values.normalized(table(spark, sf, "conversations"))


def rfc3339_timestamps(spark, sf):
    ntz = T.TimestampNTZType()
    events = table(spark, sf, "events").select(
        F.lit("events").alias("dataset_id"), F.col("event_id").alias("id"),
        values.utc_text(F.col("ts"), ntz).alias("moment"),
    )
    orders = table(spark, sf, "orders").select(
        F.lit("orders").alias("dataset_id"), F.col("o_orderkey").alias("id"),
        values.utc_text(F.col("o_orderdate"), ntz).alias("moment"),
    )
    zoned = table(spark, sf, "events").select(
        F.lit("zoned").alias("dataset_id"), F.col("event_id").alias("id"),
        values.utc_text(
            F.timestamp_micros(F.col("event_id") * 1_000_003 + 5), T.TimestampType()
        ).alias("moment"),
    )
    dates = table(spark, sf, "orders").select(
        F.lit("dates").alias("dataset_id"), F.col("o_orderkey").alias("id"),
        values.utc_text(F.to_date("o_orderdate"), T.DateType()).alias("moment"),
    )
    return events.unionByName(orders).unionByName(zoned).unionByName(dates)


def binary_to_text(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id", F.encode(F.concat(F.lit(" "), "text"), "UTF-8").alias("Body")
    )
    return values.normalized(rows)


def binary_raw_payload(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.encode("o_orderpriority", "UTF-8").alias("code")
    )
    return rows.select("o_orderkey", payload.raw_payload(rows).alias("payload"))


def _payload(name, key):
    def query(spark, sf):
        rows = table(spark, sf, name)
        return rows.select(key, payload.raw_payload(rows).alias("payload"))

    return query


def normalized_payload(spark, sf):
    rows = derive(spark, sf, PADDED)
    return rows.select(
        F.col("` C_CustKey `").alias("id"), payload.normalized_payload(rows).alias("payload")
    )


def record_key_technical(spark, sf):
    rows = derive(spark, sf, KEYED_ORDERS)
    return rows.select(
        "o_orderkey", keys.raw_key(rows, "ID", payload.raw_payload(rows)).alias("record_key")
    )


def record_key_of_moments(spark, sf):
    rows = table(spark, sf, "events")
    return rows.select(
        "event_id",
        keys.normalized_key(rows, "ts", payload.normalized_payload(rows)).alias("record_key"),
    )


def _hash(name, key, bits=64):
    def query(spark, sf):
        rows = table(spark, sf, name)
        return rows.select(
            key, keys.raw_key(rows, None, payload.raw_payload(rows), bits).alias("record_key")
        )

    return query


def raw_envelope(spark, sf):
    rows = table(spark, sf, "part")
    identity = {
        "tenant_id": "acme", "source_id": "erp", "dataset_id": "part", "execution_id": "e-1"
    }
    return raw_records(rows, identity, AT, "p_partkey").withColumn(
        "ingested_at", F.unix_micros("ingested_at")
    )


def normalized_envelope(spark, sf):
    rows = table(spark, sf, "conversations")
    identity = {
        "tenant_id": "acme", "source_id": "chat", "dataset_id": "turns", "execution_id": "e-1"
    }
    return normalized_records(rows, identity, AT).withColumn(
        "normalized_at", F.unix_micros("normalized_at")
    )


_PART = {
    name: name for name in ("p_partkey", "p_name", "p_brand", "p_type", "p_size")
} | {"p_retailprice": sql.number("p_retailprice")}
_PADDED_JSON = sql.json(
    {
        "c_custkey": '" C_CustKey "',
        "c_name": sql.trimmed('"C_NAME"'),
        "segment": sql.trimmed('"Segment"'),
        "c_acctbal": sql.number("c_acctbal"),
    }
)
_TURN = {
    "conv_id": "conv_id", "turn": "turn", "role": sql.trimmed("role"),
    "text": sql.trimmed("text"),
}
_EVENTS_NORMALIZED = {**sql.EVENTS, "event_type": "event_type", "props": "props"}

_SCALED_JSON = " || ".join(
    f"""'{"{" if name == "huge" else ","}"{name}":' || {value}"""
    for name, value in {
        "huge": sql.number_text("l_extendedprice * 1e17"),
        "l_linenumber": "l_linenumber",
        "l_orderkey": "l_orderkey",
        "l_partkey": "l_partkey",
        "large": sql.number_text("-l_extendedprice * 1e9"),
        "price": sql.number_text("l_extendedprice"),
        "small": sql.number_text("(l_quantity / 3e4)"),
        "tiny": sql.number_text("(l_tax / 7e6)"),
    }.items()
)
_NESTED_JSON = f"""
'{{"deep":{{"customer":{{"key":' || o_custkey || ',"segment":' || cast(to_json(o_orderpriority) AS varchar)
|| '}},"missing":null,"total":' || {sql.number_text("o_totalprice")}
|| '}},"list":[{{"half":' || {sql.number_text("(o_totalprice / 2)")} || ',"status":'
|| cast(to_json(o_orderstatus) AS varchar) || '}},null],"o_orderkey":' || o_orderkey
|| ',"parts":{{"a":null,"b":' || {sql.number_text("(o_totalprice * 1e18)")} || ',"z' || o_orderstatus
|| '":' || {sql.number_text("(o_totalprice / 1e9)")} || '}}}}'
"""

QUERIES = {
    "record_key_hash_doubles": (
        record_key_hash_doubles,
        f"""SELECT l_orderkey, l_linenumber, substr(sha256({_SCALED_JSON} || '}}'), 1, 16) AS record_key
            FROM lineitem""",
    ),
    "raw_payload_nested": (
        raw_payload_nested, f"SELECT o_orderkey, {_NESTED_JSON} AS payload FROM orders",
    ),
    "normalized_columns": (
        normalized_columns,
        f"""
        SELECT " C_CustKey " AS c_custkey, {sql.trimmed('"C_NAME"')} AS c_name,
               {sql.trimmed('"Segment"')} AS segment, c_acctbal
        FROM {as_sql(PADDED_DUCK)} p
        """,
    ),
    "normalized_texts": (
        normalized_texts,
        f"SELECT doc_id, {sql.trimmed('text')} AS text, {sql.trimmed('lang')} AS lang, "
        f"{sql.trimmed('source')} AS source, n_chars FROM documents",
    ),
    "normalized_conversations": (
        normalized_conversations,
        f"SELECT conv_id, turn, {sql.trimmed('role')} AS role, {sql.trimmed('text')} AS text "
        "FROM conversations",
    ),
    "rfc3339_timestamps": (
        rfc3339_timestamps,
        f"""
        SELECT 'events' AS dataset_id, event_id AS id, {sql.utc('ts')} AS moment FROM events
        UNION ALL SELECT 'orders', o_orderkey, {sql.utc('o_orderdate')} FROM orders
        UNION ALL SELECT 'zoned', event_id,
            {sql.utc('make_timestamp(event_id * 1000003 + 5)')} FROM events
        UNION ALL SELECT 'dates', o_orderkey,
            strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z' FROM orders
        """,
    ),
    "binary_to_text": (
        binary_to_text, "SELECT doc_id, ' ' || text AS body FROM documents",
    ),
    "binary_raw_payload": (
        binary_raw_payload,
        "SELECT o_orderkey, "
        + sql.json({"o_orderkey": "o_orderkey", "code": "base64(encode(o_orderpriority))"})
        + " AS payload FROM orders",
    ),
    "raw_payload_events": (
        _payload("events", "event_id"),
        f"SELECT event_id, {sql.json(sql.EVENTS)} AS payload FROM events",
    ),
    "raw_payload_orders": (
        _payload("orders", "o_orderkey"),
        f"SELECT o_orderkey, {sql.json(sql.ORDERS)} AS payload FROM orders",
    ),
    "raw_payload_pages": (
        _payload("pages", "page_id"),
        f"SELECT page_id, {sql.json(sql.PAGES)} AS payload FROM pages",
    ),
    "normalized_payload": (
        normalized_payload,
        f"""SELECT " C_CustKey " AS id, {_PADDED_JSON} AS payload
            FROM {as_sql(PADDED_DUCK)} p""",
    ),
    "record_key_technical": (
        record_key_technical,
        f"""
        SELECT o_orderkey, coalesce(cast(id AS varchar), {sql.hash_key(sql.json(
            {"id": "id", "o_orderkey": "o_orderkey", "o_orderpriority": "o_orderpriority"}
        ))}) AS record_key FROM {as_sql(KEYED_ORDERS)} k
        """,
    ),
    "record_key_of_moments": (
        record_key_of_moments,
        f"SELECT event_id, {sql.utc('ts')} AS record_key FROM events",
    ),
    "record_key_hash": (
        _hash("documents", "doc_id"),
        f"SELECT doc_id, {sql.hash_key(sql.json(sql.DOCUMENTS))} AS record_key FROM documents",
    ),
    "record_key_hash_escapes": (
        _hash("pages", "page_id"),
        f"SELECT page_id, {sql.hash_key(sql.json(sql.PAGES))} AS record_key FROM pages",
    ),
    "record_key_wide": (
        _hash("customer", "c_custkey", 256),
        f"SELECT c_custkey, {sql.hash_key(sql.json(sql.CUSTOMER), 64)} AS record_key "
        "FROM customer",
    ),
    "raw_envelope": (
        raw_envelope,
        f"""
        SELECT 'acme' AS tenant_id, 'erp' AS source_id, 'part' AS dataset_id,
               'e-1' AS execution_id, cast(p_partkey AS varchar) AS record_key,
               {sql.json(_PART)} AS payload,
               epoch_us(timestamp '2024-06-01 12:00:00') AS ingested_at
        FROM part
        """,
    ),
    "normalized_envelope": (
        normalized_envelope,
        f"""
        SELECT 'acme' AS tenant_id, 'chat' AS source_id, 'turns' AS dataset_id,
               'e-1' AS execution_id, {sql.hash_key(sql.json(_TURN))} AS record_key,
               {sql.json(_TURN)} AS payload,
               epoch_us(timestamp '2024-06-01 12:00:00') AS normalized_at
        FROM conversations
        """,
    ),
}
