"""Table sinks: JDBC in batches, or files through the same call."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Fixed value: rows per insert batch.
INSERT_ROWS = 500


def jdbc_write_options(
    url: str,
    table: str,
    connections: int = 8,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
) -> dict[str, str]:
    """``connections`` bounds how many tasks write at once."""
    options = {"url": url, "dbtable": table, "batchsize": str(INSERT_ROWS), "numPartitions": str(connections)}
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    return options


def append_rows(rows: DataFrame, format: str = "jdbc", **options: str) -> None:
    """Appends rows; an error surfaces instead of being counted as a success.

    JDBC commits per task, so a retried task can insert again: give the table a
    unique key on (code, report_time) or load through a staging table.
    """
    writer = rows.write.mode("append").format(format)
    writer.options(**(jdbc_write_options(**options) if format == "jdbc" else options)).save()


def write_each_batch(path: str, format: str = "parquet"):
    """A table of batches for a stream's ``foreachBatch``: a batch that is replayed replaces itself.

    Each batch has a folder of its own, ``batch_id=<n>`` below ``path``. A reader of ``path`` sees every row once and
    the batch as a column. Load databases from there, or with a unique key on (batch_id, row).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(format).save(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write
