"""Write, audit, publish (S8, S10, Q9): a catalog view is moved to a new version only after its checks.

Readers use the view's name, through ``spark.table`` or SQL.  A version is
written beside the published one, checked as it was written, and only a passing
one becomes what the view shows; a failing one stays where it is, unpublished.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from servicelake.operators import quality
from servicelake.session import shared_path


def published(spark: SparkSession, view: str) -> str | None:
    """The folder that the view shows, or None before anything was published."""
    if not spark.catalog.tableExists(view):
        return None
    return spark.sql(f"SHOW TBLPROPERTIES {view} ('version')").first()["value"]


def publish(df: DataFrame, view: str, checks: Sequence[quality.Check], root: str | None = None, as_of: str | None = None) -> DataFrame:
    """Write ``df``, check what was written, and show it under ``view``; returns the check results.

    A failed error-severity check raises ``QualityGateError`` and leaves the
    view with what it showed before.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{view}/v-{uuid.uuid4().hex[:12]}" if root else shared_path(spark, "published", view)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    results = spark.createDataFrame(quality.run_checks(written, view, list(checks), as_of).collect(), quality.RESULT_SCHEMA)  # a row for each check
    quality.gate(results)
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('version' = '{path}') AS SELECT * FROM parquet.`{path}`")
    return results
