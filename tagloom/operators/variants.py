"""Change records of tables no contract knows: rows as VARIANT, with a schema found for each table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import written


def variant_rows(messages: DataFrame) -> DataFrame:
    """(source_table, ts_ms, row) of every change record that holds a row, whatever its table; broken text falls away.

    Records and their parts go through ``inline``, as in ``parsing.parsed``: a filter pushed below either would parse each
    record again for every condition.
    """
    present = messages.filter(F.col("value").isNotNull())
    record = present.select(F.inline(F.array(F.struct(F.try_parse_json("value").alias("record")))))
    parts = F.struct(
        F.try_variant_get("record", "$.source.table", "string").alias("source_table"),
        F.try_variant_get("record", "$.ts_ms", "bigint").alias("ts_ms"),
        F.try_variant_get("record", "$.after", "variant").alias("row"),
    )
    return record.select(F.inline(F.array(parts))).filter(
        F.col("source_table").isNotNull() & F.col("row").isNotNull() & ~F.is_variant_null("row")
    )


def found_types(rows: DataFrame) -> DataFrame:
    """(source_table, path, type, rows): the types met at every path of each table's rows, nested objects by dotted path.

    Numbers that are whole are BIGINT, other ones DECIMAL or DOUBLE; an array is one type. Rows are counted by their whole
    schema, combined before the shuffle; the counts are written, so ``rows`` are read once, and only the schemas that differ
    are opened. Rows that are lists, if there are any, are read again and opened themselves.
    """
    paths = F.udf(paths_of, "array<struct<path string, type string>>")
    shapes = written(
        rows.groupBy("source_table", F.schema_of_variant("row").alias("shape")).agg(F.count(F.lit(1)).alias("rows")), "variant-shapes"
    )
    counted = shapes.filter(F.col("shape").startswith("OBJECT")).select("source_table", F.inline(paths("shape")), "rows")
    if not shapes.filter(F.col("shape").startswith("ARRAY")).isEmpty():
        lists = written(rows.filter(F.try_variant_get("row", "$[0]", "variant").isNotNull()), "variant-lists")
        counted = counted.unionByName(_types_by_level(lists))
    return counted.groupBy("source_table", "path", "type").agg(F.sum("rows").alias("rows"))


# A name (quoted where it is no plain word), the start or end of what nests, or a type.
_TOKEN = re.compile(r"`((?:[^`]|``)*)`: |(\w+): |(OBJECT<|ARRAY<|>)|([A-Z]+)[A-Z_]*(?:\([0-9,]+\))?")


def paths_of(shape: str) -> list[tuple[str, str]]:
    """Dotted path and type of every field of a schema as ``schema_of_variant`` writes it; lists are not opened."""
    found: list[tuple[str, str]] = []
    prefix: list[str] = []
    name, in_list = "", 0
    for quoted, plain, nested, kind in _TOKEN.findall(shape):
        if nested == ">":
            if in_list:
                in_list -= 1
            else:
                prefix.pop()
        elif in_list:
            in_list += bool(nested)
        elif nested == "OBJECT<":
            prefix.append(f"{prefix[-1]}{name}." if prefix else "")
        elif nested == "ARRAY<":
            found.append((prefix[-1] + name, "ARRAY"))
            in_list = 1
        elif kind:
            found.append((prefix[-1] + name, kind))
        else:
            name = plain or quoted.replace("``", "`")
    return found


def _types_by_level(rows: DataFrame) -> DataFrame:
    """Types by path, objects opened level by level until none is left, as many times as they are nested."""
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    counted = None
    level = rows.select("source_table", F.lit("").alias("prefix"), F.col("row").alias("whole"))
    while True:
        fields = rows.sparkSession.tvf.variant_explode(F.col("whole").outer())
        opened = level.lateralJoin(fields).select("source_table", F.concat("prefix", "key").alias("path"), "value")
        typed = opened.withColumn("type", kind)
        own = typed.filter("type <> 'OBJECT'").groupBy("source_table", "path", "type").agg(F.count(F.lit(1)).alias("rows"))
        counted = own if counted is None else counted.unionByName(own)
        level = typed.filter("type = 'OBJECT'").select("source_table", F.concat("path", F.lit(".")).alias("prefix"), F.col("value").alias("whole"))
        if level.isEmpty():
            return counted


def schema_of(types: DataFrame, table: str) -> dict[str, str]:
    """Type by path of one table: the one met, DECIMAL or DOUBLE where numbers mix, else STRING. As many as it has paths."""
    met: dict[str, set[str]] = {}
    for path, kind in types.filter(F.col("source_table") == table).select("path", "type").collect():
        met.setdefault(path, set()).add(kind)
    return {path: _common(kinds - {"VOID"}) for path, kinds in sorted(met.items())}


def _common(kinds: set[str]) -> str:
    if len(kinds) == 1 and kinds <= {"BIGINT", "DOUBLE", "BOOLEAN"}:
        return min(kinds)
    if kinds and kinds <= {"BIGINT", "DECIMAL"}:
        return "DECIMAL(38,10)"
    if kinds and kinds <= {"BIGINT", "DECIMAL", "DOUBLE", "FLOAT"}:
        return "DOUBLE"
    return "STRING"


def typed_rows(rows: DataFrame, table: str, schema: dict[str, str]) -> DataFrame:
    """One table's rows as columns of a schema found for it (dots become underscores), next to ``ts_ms``; a value that does not fit is NULL."""
    columns = [
        F.try_variant_get("row", "$" + "".join(f"['{part}']" for part in path.split(".")), kind).alias(path.replace(".", "_"))
        for path, kind in schema.items()
    ]
    return rows.filter(F.col("source_table") == table).select("ts_ms", *columns)
