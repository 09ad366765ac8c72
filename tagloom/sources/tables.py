"""Relational tables: stored files or JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The stored tables of one folder; each is opened at most once.

    ``topics`` are folders of messages (parquet, column ``value``) by topic name, where they are stored already.
    """

    def __init__(
        self, spark: SparkSession, folder: str, format: str = "parquet", topics: dict[str, str] | None = None
    ) -> None:
        self.spark = spark
        self._topics = topics or {}
        self.folder = folder.rstrip("/")
        self._format = format
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.format(self._format).load(f"{self.folder}/{name}.{self._format}")
        return self._opened[name]

    def topic(self, name: str) -> DataFrame | None:
        """Stored messages of a topic, if there are any."""
        path = self._topics.get(name)
        return None if path is None else self.spark.read.schema("value STRING").parquet(path)


def jdbc_options(
    url: str,
    query: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Reader options. Result columns carry the names the query gives them.

    With ``partition_column`` the query is read as that many key ranges by
    separate tasks; without it one task reads everything, which suits
    dimension tables only.
    """
    options = {"url": url, "fetchsize": str(fetch_rows)}
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    if partition_column is None:
        return {**options, "query": query}
    if lower is None or upper is None:
        raise ValueError("a partitioned read needs lower and upper")
    return {
        **options,
        "dbtable": f"({query}) q",
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_query(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def camel_case(name: str) -> str:
    first, *rest = name.lower().split("_")
    return first + "".join(part.capitalize() for part in rest)


def camel_columns(df: DataFrame) -> DataFrame:
    """``tm_name`` and ``TM_NAME`` -> ``tmName`` for every column."""
    return df.withColumnsRenamed({name: camel_case(name) for name in df.columns})
