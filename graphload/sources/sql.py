"""A SQL sentence over catalog tables or given frames."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame, SparkSession

# entities load concurrently and may use equal view names
_views = Lock()


def sql_source(spark: SparkSession, sentence: str, views: dict[str, DataFrame] | None = None
               ) -> DataFrame:
    """Rows of a Spark SQL sentence over the catalog and the frames in ``views``.

    Names are resolved when the sentence is parsed, so the views are gone again
    afterwards, and views of the session they hid are back.
    """
    if not views:
        return spark.sql(sentence)
    with _views:
        hidden = {name: spark.table(name) for name in views if _is_view(spark, name)}
        try:
            for name, df in views.items():
                df.createOrReplaceTempView(name)
            return spark.sql(sentence)
        finally:
            for name in views:
                spark.catalog.dropTempView(name)
            for name, df in hidden.items():
                df.createOrReplaceTempView(name)


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary
