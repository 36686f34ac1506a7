"""Schema accessibility of registered sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.defaults import null_to_empty

# Fixed value.
VALIDATED = "connection validated: host reachable, authentication ok, database and schema accessible"


# The texts about a schema that cannot be seen.
NOT_ACCESSIBLE = ("connection ok but ", " is not accessible")
NO_SCHEMA = " does not exist or is not accessible to the configured user"


def check_schemas(sources: DataFrame, schemata: DataFrame) -> DataFrame:
    """Sources with ``success``, ``message`` and ``error``.

    ``schemata`` lists (tenant_id, source_id, schema_name) as the sources' catalogs show them.
    A source without a configured schema passes.
    """
    keys = ["tenant_id", "source_id", "schema_name"]
    visible = schemata.select(*keys).distinct().withColumn("_visible", F.lit(True))
    wanted = null_to_empty(F.col("schema_name"))
    success = (wanted == "") | F.coalesce("_visible", F.lit(False))
    quoted = F.concat(F.lit('schema "'), wanted, F.lit('"'))
    return (
        sources.join(visible, keys, "left")
        .withColumn("success", success)
        .withColumn(
            "message",
            F.when(F.col("success"), F.lit(VALIDATED)).otherwise(
                F.concat(F.lit(NOT_ACCESSIBLE[0]), quoted, F.lit(NOT_ACCESSIBLE[1]))
            ),
        )
        .withColumn(
            "error",
            F.when(
                ~F.col("success"),
                F.concat(quoted, F.lit(NO_SCHEMA)),
            ),
        )
        .select(*sources.columns, "success", "message", "error")
    )


def inaccessible(sources: DataFrame, schemata: DataFrame) -> DataFrame:
    """Only the sources whose configured schema is not visible."""
    keys = ["tenant_id", "source_id", "schema_name"]
    configured = sources.where(null_to_empty(F.col("schema_name")) != "")
    return configured.join(schemata.select(*keys), keys, "left_anti").select(*sources.columns)
