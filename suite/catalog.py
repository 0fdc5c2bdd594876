"""Catalogue and basket queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.registry import half_up, oracle, query, view
from tidemark.functions import keys, scores
from tidemark.operators import catalog


def _views(spark, sf):
    return view(spark, sf, "f7_products"), view(spark, sf, "f7_variants")


_PRICED = """SELECT p.product_id, v.variant, COALESCE(v.variant_price, p.price) AS price
    FROM f7_products p LEFT JOIN f7_variants v ON v.product_id = p.product_id"""
_LINES = """SELECT basket, product_id, variant, SUM(qty) AS qty FROM f7_cart GROUP BY 1, 2, 3"""
_JOINED = """SELECT c.basket, c.product_id, c.variant, c.qty, COALESCE(v.variant_price, p.price) AS unit_price
    FROM c JOIN f7_products p ON p.product_id = c.product_id
    LEFT JOIN f7_variants v ON v.product_id = c.product_id AND v.variant = c.variant"""


@query("effective_price", oracle("f7_products", "f7_variants", sql=f"""
    SELECT product_id, variant, ROUND(price, 6) AS effective_price FROM ({_PRICED})"""))
def effective_price(spark, sf):
    priced = catalog.priced_variants(*_views(spark, sf))
    return priced.select("product_id", "variant", F.round("effective_price", 6).alias("effective_price"))


@query("showcase_price", oracle("f7_products", "f7_variants", p=_PRICED, sql="""
    SELECT product_id, ROUND(MIN(price), 6) AS showcase_price, CAST(COUNT(variant) AS BIGINT) AS n_variants,
      COUNT(variant) > 1 AND MIN(price) IS NOT NULL AS is_from_price FROM p GROUP BY 1"""))
def showcase_price(spark, sf):
    shown = catalog.showcase_price(*_views(spark, sf))
    return shown.withColumn("showcase_price", F.round("showcase_price", 6))


@query("cart_key", oracle("f7_cart", sql="""
    SELECT DISTINCT basket, product_id || '::' || variant AS line_key FROM f7_cart"""))
def cart_key(spark, sf):
    key = keys.cart_key(F.col("product_id"), F.col("variant")).alias("line_key")
    return view(spark, sf, "f7_cart").select("basket", key).distinct()


@query("cart_merge", oracle("f7_cart", sql=_LINES))
def cart_merge(spark, sf):
    return catalog.cart_merge(view(spark, sf, "f7_cart"))


@query("basket_join", oracle("f7_cart", "f7_products", "f7_variants", c="SELECT * FROM f7_cart", sql=f"""
    SELECT basket, product_id, variant, qty, ROUND(unit_price, 6) AS unit_price FROM ({_JOINED})"""))
def basket_join(spark, sf):
    lines = catalog.basket_join(view(spark, sf, "f7_cart"), *_views(spark, sf))
    return lines.select("basket", "product_id", "variant", "qty", F.round("unit_price", 6).alias("unit_price"))


_TEXT = "'R$' || CHR(160) || TRANSLATE(FORMAT('{{:,.2f}}', {0}), ',.', '.,')"
_MONEY = _TEXT.format("total")


@query("basket_totals", oracle("f7_cart", "f7_products", "f7_variants", c=_LINES, j=_JOINED, t=f"""
    SELECT u.basket, u.units, CAST(u.lines AS BIGINT) AS lines, {half_up('COALESCE(j.total, 0.0)', 2)} AS total,
      COALESCE(j.has_open, FALSE) AS has_open_price
    FROM (SELECT basket, SUM(qty) AS units, COUNT(*) AS lines FROM c GROUP BY 1) u
    LEFT JOIN (SELECT basket, SUM(ROUND(unit_price * qty, 6)) AS total, BOOL_OR(unit_price IS NULL) AS has_open
               FROM j GROUP BY 1) j ON j.basket = u.basket""", sql=f"""
    SELECT *, CASE WHEN has_open_price AND total = 0 THEN 'A combinar'
      WHEN has_open_price THEN {_MONEY} || ' + a combinar' ELSE {_MONEY} END AS label FROM t"""))
def basket_totals(spark, sf):
    return catalog.basket_totals(view(spark, sf, "f7_cart"), *_views(spark, sf))


@query("price_label", oracle("f7_products", sql=f"""
    SELECT product_id, CASE WHEN price IS NULL THEN 'Sob consulta' ELSE {_TEXT.format('price')} END AS label FROM f7_products"""))
def price_label(spark, sf):
    return view(spark, sf, "f7_products").select("product_id", scores.price_label(F.col("price")).alias("label"))


@query("catalog_gaps", oracle("f7_products", "f7_variants", p=_PRICED, sql="""
    SELECT CAST(COUNT(*) FILTER (WHERE shown IS NULL) AS BIGINT) AS without_price, CAST(COUNT(*) AS BIGINT) AS products
    FROM (SELECT product_id, MIN(price) AS shown FROM p GROUP BY 1)"""))
def catalog_gaps(spark, sf):
    return catalog.catalog_gaps(*_views(spark, sf))


@query("pending_items", oracle("f7_products", sql="""
    SELECT product_id, CAST((price IS NULL)::INTEGER + (product_id % 2 = 0)::INTEGER AS INTEGER) AS pending FROM f7_products"""))
def pending_items(spark, sf):
    open_points = F.array_compact(F.array(
        F.when(F.col("price").isNull(), "preço"), F.when(F.col("product_id") % 2 == 0, "peso")))
    return catalog.pending_items(view(spark, sf, "f7_products").withColumn("p", open_points), "p")


@query("category_filter", oracle("f7_products", sql="""
    SELECT category, CAST(COUNT(*) AS BIGINT) AS products FROM f7_products
    WHERE category = (SELECT MIN(category) FROM f7_products) GROUP BY 1"""))
def category_filter(spark, sf):
    products = view(spark, sf, "f7_products")
    wanted = products.agg(F.min("category")).first()[0]
    kept = catalog.category_filter(products, wanted)
    return kept.groupBy("category").agg(F.count("*").alias("products"))
