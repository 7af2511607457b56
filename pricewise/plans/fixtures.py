"""Bindings of the sale record and the index series to the driver tables.

Sale view = lineitem ⋈ part ⋈ orders, every row. The sparse sale view leaves
out LARGE rows shipped in months 8–11 (unobserved months) and PROMO rows with
quantity > 5 (a sparse body); only the queries about such cells read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.functions.dates import year_month
from pricewise.sources.tables import read_table

SALE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
SALE_COLUMNS = SALE_KEY + ["make", "model", "body", "year", "saledate", "sale_month",
                           "year_month", "vehicle_age", "odometer", "condition",
                           "transmission", "sellingprice"]
INDEX_SERIES = ["price", "quantity", "volume"]
INDEX_BASE_YEAR = 1998


def sale_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    # orders first: the part's texts come in after the last shuffle of the sales
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
         .join(part, li.l_partkey == part.p_partkey))
    ship_month = F.month("l_shipdate")
    return j.select(
        *SALE_KEY,
        F.col("p_brand").alias("make"),
        F.col("p_name").alias("model"),
        F.when(F.col("p_type").isin("ECONOMY", "SMALL"), F.lit("compact"))
        .otherwise(F.lower("p_type")).alias("body"),
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.col("l_shipdate").alias("saledate"),
        ship_month.cast("bigint").alias("sale_month"),
        year_month(F.col("l_shipdate")).alias("year_month"),
        F.greatest(F.year("l_shipdate") - F.year("o_orderdate"), F.lit(0)).cast("bigint")
        .alias("vehicle_age"),
        (F.col("l_quantity") * 1000).cast("bigint").alias("odometer"),
        F.nullif(F.col("l_discount") * 50, F.lit(0.0)).alias("condition"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("transmission"),
        F.col("l_extendedprice").alias("sellingprice"),
    )


def sparse_sale_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sale view without some (body, month) cells and with one sparse body."""
    body = F.col("body")
    return sale_view(spark, sf_dir).where(
        ~((body == "large") & F.col("sale_month").between(8, 11))
        & ~((body == "promo") & (F.col("odometer") > 5000)))


def price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly mean order price (order month): the price index series."""
    o = read_table(spark, sf_dir, "orders", ["o_totalprice", "o_orderdate"])
    return (o.groupBy(year_month(F.col("o_orderdate")).alias("year_month"))
            .agg((F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
                  / F.count(F.lit(1))).alias("price")))


def series_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three monthly series in long form (series, year_month, value):
    mean order price by order month; mean quantity and line count by ship month."""
    p = price_series(spark, sf_dir).select(F.lit("price").alias("series"), "year_month",
                                           F.col("price").alias("value"))
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_shipdate"])
    m = li.groupBy(year_month(F.col("l_shipdate")).alias("year_month")).agg(
        F.avg("l_quantity").alias("quantity"), F.count(F.lit(1)).cast("double").alias("volume"))
    q = m.select(F.lit("quantity").alias("series"), "year_month", F.col("quantity").alias("value"))
    v = m.select(F.lit("volume").alias("series"), "year_month", F.col("volume").alias("value"))
    return p.unionByName(q).unionByName(v)


def gappy_price_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price index without any April and without months before 1995-06."""
    from pricewise.operators.index import base_ratio
    p = price_series(spark, sf_dir).where(
        (F.substring("year_month", 6, 2) != "04") & (F.col("year_month") >= "1995-06"))
    return base_ratio(p, "price", INDEX_BASE_YEAR)
