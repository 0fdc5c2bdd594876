"""Catalogue prices and baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scores import basket_label, effective_price


def priced_variants(products: DataFrame, variants: DataFrame) -> DataFrame:
    """Every product with each of its variants (or none) and the price that applies."""
    joined = products.join(variants, "product_id", "left")
    return joined.withColumn("effective_price", effective_price(F.col("variant_price"), F.col("price")))


def showcase_price(products: DataFrame, variants: DataFrame) -> DataFrame:
    """Lowest price a product is offered at; NULL when none is known."""
    lowest = priced_variants(products, variants).groupBy("product_id").agg(
        F.min("effective_price").alias("showcase_price"), F.count("variant").alias("n_variants")
    )
    return lowest.withColumn(
        "is_from_price", (F.col("n_variants") > 1) & F.col("showcase_price").isNotNull()
    )


def cart_merge(cart: DataFrame) -> DataFrame:
    """Same product and variant in a basket become one line."""
    return cart.groupBy("basket", "product_id", "variant").agg(F.sum("qty").alias("qty"))


def basket_join(cart: DataFrame, products: DataFrame, variants: DataFrame) -> DataFrame:
    """Cart lines with their price; lines of unknown products are dropped."""
    priced = cart.join(products.select("product_id", "price"), "product_id")
    joined = priced.join(variants, ["product_id", "variant"], "left")
    return joined.withColumn("unit_price", effective_price(F.col("variant_price"), F.col("price")))


def basket_totals(cart: DataFrame, products: DataFrame, variants: DataFrame) -> DataFrame:
    """Sum of the priced lines, whether a price is open, units and the label shown.

    Lines are merged before the price joins, which shrinks what they shuffle.
    """
    merged = cart_merge(cart)
    units = merged.groupBy("basket").agg(F.sum("qty").alias("units"), F.count("*").alias("lines"))
    priced = basket_join(merged, products, variants).groupBy("basket").agg(
        F.sum(F.col("unit_price") * F.col("qty")).alias("total"),
        F.bool_or(F.col("unit_price").isNull()).alias("has_open_price"),
    )
    total = F.round(F.coalesce("total", F.lit(0.0)), 2)
    has_open = F.coalesce("has_open_price", F.lit(False))
    return units.join(priced, "basket", "left").select(
        "basket", "units", "lines", total.alias("total"), has_open.alias("has_open_price"),
        basket_label(total, has_open, F.col("lines")).alias("label"),
    )


def catalog_gaps(products: DataFrame, variants: DataFrame) -> DataFrame:
    """Products nobody can price yet."""
    return showcase_price(products, variants).agg(
        F.count_if(F.col("showcase_price").isNull()).alias("without_price"),
        F.count("*").alias("products"),
    )


def pending_items(products: DataFrame, pending: str) -> DataFrame:
    """Open points listed per product."""
    return products.select("product_id", F.size(F.coalesce(pending, F.array())).alias("pending"))


def category_filter(products: DataFrame, category: str | None) -> DataFrame:
    return products if category is None else products.where(F.col("category") == category)
