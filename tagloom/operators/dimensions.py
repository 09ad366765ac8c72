"""Dimension tables and the lookups into them.

How a dimension is joined is left to Spark, by bytes: write a derived one with
``session.written`` before facts look things up in it. A small one is then
broadcast without moving the facts; a large one is a shuffled left join whose
skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import textrows
from tagloom.operators.as_of import as_of_join


def category_dim(category3: DataFrame, category2: DataFrame, category1: DataFrame) -> DataFrame:
    """Third-level categories with the names of all three levels."""
    c1 = category1.select(F.col("id").alias("_c1"), F.col("name").alias("b1name"))
    c2 = category2.select(F.col("id").alias("_c2"), F.col("name").alias("b2name"), F.col("category1_id").alias("_up1"))
    c3 = category3.select("id", F.col("name").alias("b3name"), F.col("category2_id").alias("_up2"))
    return (
        c3.join(c2, c3["_up2"] == c2["_c2"])
        .join(c1, F.col("_up1") == F.col("_c1"))
        .select("id", "b3name", "b2name", "b1name")
    )


def sku_dim(sku: DataFrame, spu: DataFrame, trademark: DataFrame) -> DataFrame:
    """Sale units with their product, third-level category and brand name."""
    products = spu.select(F.col("id").alias("spuid"), F.col("category3_id").alias("c3id"), F.col("tm_id").alias("_tm"))
    brands = trademark.select(F.col("id").alias("_brand"), F.col("tm_name").alias("tname"))
    return (
        sku.select(F.col("id").alias("skuid"), F.col("spu_id").alias("_spu"))
        .join(products, F.col("_spu") == F.col("spuid"))
        .join(brands, F.col("_tm") == F.col("_brand"))
        .select("skuid", "spuid", "c3id", "tname")
    )


def with_sku(rows: DataFrame, skus: DataFrame) -> DataFrame:
    """Adds category id and brand by ``sku_id``; NULL for an unknown unit."""
    dim = skus.select(F.col("skuid").alias("sku_id"), "c3id", "tname")
    return rows.join(dim, "sku_id", "left")


def with_top_category(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """Adds the first-level category name by ``c3id``; NULL for an unknown category."""
    dim = categories.select(F.col("id").alias("c3id"), F.col("b1name").alias("b1_name"))
    return rows.join(dim, "c3id", "left")


def product_dim(skus: DataFrame, categories: DataFrame) -> DataFrame:
    """Sale units with brand and first-level category.

    The category of an order detail only ever comes from its unit, so the two
    dimensions are joined to each other and the details look up once, not twice.
    """
    return with_top_category(skus, categories).select("skuid", "c3id", "tname", "b1_name")


def with_product(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Adds category id, brand and first-level category by ``sku_id``; NULL for an unknown unit."""
    return rows.join(products.withColumnRenamed("skuid", "sku_id"), "sku_id", "left")


def search_dim(categories: DataFrame, comparison: DataFrame) -> DataFrame:
    """Search term -> first-level category and search category.

    Third-level names repeat: the highest id wins. A category listed more than
    once in the comparison table takes its lowest id.
    """
    by_name = categories.groupBy(F.col("b3name").alias("term")).agg(F.max_by("b1name", "id").alias("b1_category"))
    by_category = comparison.groupBy(F.col("category_name").alias("b1_category")).agg(
        F.min_by("search_category", "id").alias("search_category")
    )
    return by_name.join(by_category, "b1_category", "left").select("term", "b1_category", "search_category")


def with_search_category(rows: DataFrame, searches: DataFrame, term: str = "search_item") -> DataFrame:
    """Adds both categories by the search text; a text of several terms matches nothing."""
    return rows.join(searches.withColumnRenamed("term", term), term, "left")


def latest_rates(rules: DataFrame) -> DataFrame:
    """(id, rate): ``rules.value`` holds ``id:rate`` with ``seq`` saying which rule is the latest."""
    return (
        rules.select(*textrows.rate_rule(F.col("value")), "seq")
        .groupBy("id")
        .agg(F.max_by("rate", "seq").alias("rate"))
    )


def adjusted_prices(orders: DataFrame, rates: DataFrame) -> DataFrame:
    """Price times the rate of the product, 1.0 without one, as text with two decimals.

    ``orders.value`` holds ``id,name,price``; ``rates`` is what ``latest_rates`` gives.
    """
    items = orders.select(*textrows.priced_item(F.col("value")))
    return items.join(rates, "id", "left").select(*rated_columns())


def rated_columns() -> list[Column | str]:
    """id, name, price, rate and adjusted price as text, of rows with a price and a rate or NULL."""
    rate = F.coalesce("rate", F.lit(1.0))
    return [
        "id",
        "name",
        textrows.fixed_point(F.col("price"), 2).alias("price"),
        textrows.fixed_point(rate, 2).alias("rate"),
        textrows.fixed_point(F.col("price") * rate, 2).alias("adjusted"),
    ]


def prices_as_of(orders: DataFrame, rules: DataFrame) -> DataFrame:
    """Like ``adjusted_prices``, with the rate that held at the order's own time ``ts_ms``; 1.0 before the first rule.

    ``rules`` has ``value``, ``ts_ms`` and ``seq``, which orders rules of one time.
    """
    items = orders.select(*textrows.priced_item(F.col("value")), "ts_ms")
    known = rules.select(*textrows.rate_rule(F.col("value")), "ts_ms", "seq").filter(F.col("rate").isNotNull())
    found = as_of_join(items, known, "id", "ts_ms", ["rate"], ["seq"])
    return found.select(*rated_columns(), "ts_ms")
