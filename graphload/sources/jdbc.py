"""Database tables and queries over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Database -> (URL pattern, driver class).
PRESETS = {
    "mysql": ("jdbc:mysql://{host}:{port}/{database}?useUnicode=true&characterEncoding=utf-8",
              "com.mysql.cj.jdbc.Driver"),
    "postgresql": ("jdbc:postgresql://{host}:{port}/{database}", "org.postgresql.Driver"),
    "clickhouse": ("jdbc:clickhouse://{host}:{port}/{database}",
                   "ru.yandex.clickhouse.ClickHouseDriver"),
    "oracle": ("jdbc:oracle:thin:@{host}:{port}/{database}", "oracle.jdbc.driver.OracleDriver"),
}


def jdbc_url(kind: str, host: str, port: int, database: str) -> str:
    return PRESETS[kind][0].format(host=host, port=port, database=database)


def jdbc_options(url: str, driver: str, table: str | None = None, sentence: str | None = None,
                 user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, num_partitions: int | None = None,
                 fetch_size: int | None = None) -> dict[str, str]:
    """Reader options. Exactly one of table and sentence; a sentence runs in the database."""
    if bool(table and table.strip()) == bool(sentence and sentence.strip()):
        raise ValueError("give either a table or a sentence")
    ranged = [partition_column, lower, upper]
    if any(v is not None for v in ranged) and None in (*ranged, num_partitions):
        raise ValueError("a partitioned read needs column, lower, upper and partition count")
    options = {"url": url, "driver": driver}
    if partition_column is not None:
        # Spark splits only named tables, so a sentence becomes a derived table
        options["dbtable"] = table or f"({sentence}) t"
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower),
                    "upperBound": str(upper)}
    elif table:
        options["dbtable"] = table
    else:
        options["query"] = sentence
    for key, value in (("user", user), ("password", password), ("fetchsize", fetch_size),
                       ("numPartitions", num_partitions)):
        if value is not None:
            options[key] = str(value)
    return options


def read_jdbc(spark: SparkSession, url: str, driver: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, driver, **options)).load()
