"""Option building and read planning; no database is contacted."""

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from tidemark.sources import jdbc


def options(connector, **changes):
    base = dict(host="h", port=1, database="db", username="u", password="p")
    return jdbc.connection_options(connector, **{**base, **changes})


def test_connection_options():
    assert options("postgres") == {
        "url": "jdbc:postgresql://h:1/db?sslmode=disable&connectTimeout=10",
        "driver": "org.postgresql.Driver", "user": "u", "password": "p",
    }
    assert "sslmode=verify-full" in options("postgres", ssl_mode="verify-full")["url"]
    assert options("mysql")["url"] == "jdbc:mysql://h:1/db?sslMode=DISABLED&connectTimeout=10000"
    assert "sslMode=VERIFY_IDENTITY" in options("mysql", ssl_mode="require")["url"]
    assert "sslMode=DISABLED" in options("mysql", ssl_mode="prefer")["url"]
    assert options("sqlserver", database="a;b}")["url"] == (
        "jdbc:sqlserver://h:1;databaseName={a;b}}};loginTimeout=10"
    )
    with pytest.raises(ValueError, match="unsupported connector type: oracle"):
        options("oracle")


@pytest.mark.parametrize(
    "connector, plain, odd",
    [
        ("postgres", '"s"."t"', '"a""b"'), ("mysql", "`s`.`t`", '`a"b`'),
        ("sqlserver", "[s].[t]", '[a"b]'),
    ],
)
def test_quoting(connector, plain, odd):
    assert jdbc.qualified_table(connector, "s", "t") == plain
    assert jdbc.qualified_table(connector, None, 'a"b') == odd
    assert jdbc.qualified_table(connector, "", 'a"b') == odd
    assert jdbc.quoted("sqlserver", "x]y") == "[x]]y]"
    assert jdbc.quoted("mysql", "x`y") == "`x``y`"


def test_text_key_shares_cover_every_row(spark):
    """With MySQL's function, which Spark SQL has too."""
    shares = jdbc.text_key_shares("mysql", "key", 7)
    rows = spark.range(500).selectExpr(
        "if(id % 50 = 0, NULL, concat('k', id)) AS key"
    )
    rows = rows.selectExpr("key", *(f"cast({s} AS int) AS s{i}" for i, s in enumerate(shares)))
    for row in rows.collect():
        assert sum(row[f"s{i}"] or 0 for i in range(7)) == 1


@pytest.mark.parametrize(
    "key, cursor, expected",
    [
        ("ID", "at", ("id", "range")), (None, "at", ("at", "range")),
        ("code", None, ("code", "hash")), ("code", "at", ("at", "range")),
        ("flag", None, (None, "single")), (None, None, (None, "single")),
        ("missing", None, (None, "single")),
    ],
)
def test_plan_partitions(key, cursor, expected):
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()), T.StructField("at", T.TimestampType()),
            T.StructField("code", T.StringType()), T.StructField("flag", T.BooleanType()),
        ]
    )
    plan = jdbc.plan_partitions(schema, key, cursor)
    assert (plan.column, plan.kind) == expected


class FakeReader:
    """Stands in for ``spark.read``: records options, answers from a local table."""

    def __init__(self, session):
        self.session = session
        self.settings = {}

    def format(self, name):
        assert name == "jdbc"
        return FakeReader(self.session)

    def options(self, **settings):
        other = FakeReader(self.session)
        other.settings = {**self.settings, **settings}
        return other

    def option(self, key, value):
        return self.options(**{key: value})

    def load(self):
        self.session.loads.append(self.settings)
        rows = self.session.rows
        if "query" in self.settings:
            query = self.settings["query"].replace("double precision", "double").replace('"', "`").replace("`s`.`t`", "{rows}")
            return rows.sparkSession.sql(query, rows=rows)
        return rows

    def jdbc(self, url, table, predicates, properties):
        self.session.loads.append({"url": url, "predicates": predicates, **properties})
        return self.session.rows


class FakeSession:
    def __init__(self, rows):
        self.rows = rows
        self.loads = []

    @property
    def read(self):
        return FakeReader(self)


def read(rows, **settings):
    session = FakeSession(rows)
    found = jdbc.read_table(
        session, "postgres", {"url": "jdbc:x", "user": "u"}, '"s"."t"', **settings
    )
    return found, session.loads


def test_numeric_key_is_split_into_ranges(spark):
    rows = spark.range(10, 20, 1, 8)
    found, loads = read(rows, technical_key="ID", connections=4, partitions=50)
    assert found.count() == 10
    assert found.rdd.getNumPartitions() == 4  # so many queries at a time
    free, _ = read(rows, technical_key="ID", connections=None)
    assert free.rdd.getNumPartitions() == 8
    ranged = [s for s in loads if "partitionColumn" in s]
    assert [(s["partitionColumn"], s["lowerBound"], s["upperBound"], s["numPartitions"])
            for s in ranged] == [('"id"', "10", "19", "50")]
    assert ranged[0]["fetchsize"] == "1000"


@pytest.mark.parametrize("kind", ["double", "decimal(20,3)", "decimal(30,0)", "float"])
def test_other_numbers_are_split_by_predicates(spark, kind):
    rows = spark.range(0, 1000).selectExpr(
        f"cast(if(id % 10 = 3, NULL, (id - 300) * 1234.567) AS {kind}) AS k"
    )
    found, loads = read(rows, technical_key="k", partitions=40)
    shares = loads[-1]["predicates"]
    assert len(shares) == 40 and found.count() == 1000
    in_spark = [s.replace('"k"', "k") for s in shares]
    counted = rows.selectExpr(*(f"count_if({s}) AS n{i}" for i, s in enumerate(in_spark))).first()
    assert sum(counted) == 1000 and max(counted) <= 140  # nulls are in the first


def test_numbers_without_a_range(spark):
    for value in ("NULL", "1.5D", "double('NaN')", "double('Infinity')"):
        found, loads = read(spark.sql(f"SELECT {value} AS k"), technical_key="k")
        assert found.count() == 1 and "predicates" not in loads[-1]


def test_text_key_is_split_by_hash(spark):
    rows = spark.range(5).selectExpr("cast(id AS string) AS code")
    _, loads = read(rows, technical_key="code", connections=3)
    shares = loads[-1]["predicates"]
    assert len(shares) == 3 and "IS NULL" in shares[0] and loads[-1]["url"] == "jdbc:x"


def test_read_is_bounded_by_the_greatest_cursor(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id int, v int")
    found, _ = read(rows, technical_key="id", incremental_column="V")
    assert found.count() == 3
    # Rows that arrive after the bound was taken are left for the next run.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "<= 9" in plan and "isnull" in plan


def test_empty_table(spark):
    found, loads = read(spark.range(0), technical_key="id", incremental_column="id")
    assert found.count() == 0
    assert not any("partitionColumn" in s for s in loads)


def test_open_with_resolves_the_secret(spark, monkeypatch):
    seen = {}

    def read_table(session, connector, options, table, key, cursor, batch, *limits):
        seen.update(connector=connector, table=table, key=key, cursor=cursor, **options)
        seen["limits"] = limits

    monkeypatch.setattr(jdbc, "read_table", read_table)
    row = Row(
        source_connector="mysql", host="h", port=3306, database_name="db", username="u",
        password_ref="ref", ssl_mode="disable", dataset_schema="s", table_name="t",
        technical_key="id", incremental_column="at", sync_mode="full", batch_size=10,
        last_value=None,
    )
    jdbc.open_with(spark, {"ref": "secret"}.get)(row)
    assert seen["password"] == "secret" and seen["table"] == "`s`.`t`"
    assert seen["cursor"] is None and seen["limits"] == (10, 600, None, 200, True)
    jdbc.open_with(spark, {"ref": "secret"}.get, connections=3, partitions=9, query_seconds=5)(row)
    assert seen["limits"] == (3, 5, None, 9, True)


@pytest.mark.parametrize(
    "kind, text, expected",
    [
        (T.LongType(), "42", "42"), (T.DoubleType(), "1.0E10", "10000000000"),
        (T.TimestampType(), "2024-01-02T03:04:05.123456Z", "'2024-01-02 03:04:05.123'"),
        (T.DateType(), "2024-01-02T00:00:00Z", "'2024-01-02 00:00:00.000'"),
        (T.LongType(), "1; DROP TABLE t", None), (T.LongType(), "NaN", None),
        (T.TimestampType(), "<nil>", None), (T.StringType(), "a", None),
    ],
)
def test_range_literal(kind, text, expected):
    assert jdbc.range_literal(kind, text) == expected


def test_ranges_cover_the_new_rows_only(spark):
    rows = spark.range(0, 100).selectExpr("id", "id * 10 AS v")
    found, loads = read(
        rows, technical_key="id", incremental_column="v", last_value="900", connections=4
    )
    ranged = [s for s in loads if "partitionColumn" in s]
    assert [(s["lowerBound"], s["upperBound"]) for s in ranged] == [("91", "99")]
    # The ranges only divide the work; filtering by the cursor is the caller's.
    assert found.count() == 100
    nothing_new, _ = read(rows, technical_key="id", incremental_column="v", last_value="990")
    assert nothing_new.where("v > 990").count() == 0


def test_counted_ranges_of_text_and_skewed_keys(spark):
    rows = spark.range(900).selectExpr(
        "concat('k', lpad(id, 6, '0')) AS code", "if(id < 800, id, id * id * id) AS n"
    )
    for key in ("code", "N"):
        found, loads = read(rows, technical_key=key, partitions=9, connections=None, counted=True)
        shares = loads[-1]["predicates"]
        assert len(shares) == 9 and found.count() == 900
        in_spark = [s.replace('"', "") for s in shares]
        counted = rows.selectExpr(*(f"count_if({s}) AS n{i}" for i, s in enumerate(in_spark))).first()
        assert sum(counted) == 900 and max(counted) <= 110
    empty, loads = read(rows.limit(0), technical_key="n", counted=True)
    assert empty.count() == 0 and "predicates" not in loads[-1]
