"""The pipeline's batch tables over one data folder, as plans.

A catalogue is made for each query, so every query lists the folders anew
and sees new files; within it a table that is needed twice is one plan (and
Spark reuses its exchanges).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.dates import text_day
from martflow.operators import dau, dims, orders
from martflow.sources import tables


class Catalog:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of=None):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of

    def table(self, name: str) -> DataFrame:
        return tables.table(self.spark, self.sf_dir, name)

    @cached_property
    def users(self) -> DataFrame:
        return tables.user_info(self.spark, self.sf_dir)

    @cached_property
    def provinces(self) -> DataFrame:
        return tables.base_province(self.spark, self.sf_dir)

    @cached_property
    def page_log(self) -> DataFrame:
        return tables.page_log(self.spark, self.sf_dir)

    def page_log_on(self, first: str, last: str) -> DataFrame:
        return tables.page_log(self.spark, self.sf_dir, first, last)

    def dau_info(self) -> DataFrame:
        return dau.dau_info(self.page_log, self.users, self.provinces, as_of=self.as_of)

    def active_devices(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """``mid, dt, hr`` of each device's first visit of a day: the daily-active
        table without its attributes, for counting."""
        return dau.active_devices(tables.session_starts(self.spark, self.sf_dir, first, last))

    @cached_property
    def order_info_raw(self) -> DataFrame:
        return tables.order_info(self.spark, self.sf_dir)

    def order_facts(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Orders without any dimension, with their ``create_date``."""
        o = tables.order_info(self.spark, self.sf_dir, first, last, with_province=False)
        return o.withColumn("create_date", text_day("create_time"))

    def order_provinces(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Orders with the province only."""
        o = tables.order_info(self.spark, self.sf_dir, first, last)
        return dims.with_province(o, self.provinces, "province_id", {"province_name": "name"}, key_type="long")

    @cached_property
    def order_info(self) -> DataFrame:
        return orders.enrich_orders(self.order_info_raw, self.users, self.provinces, as_of=self.as_of)

    @cached_property
    def order_wide(self) -> DataFrame:
        """All wide rows; a line's time is its order's here, so it is taken from the
        order's side of the join."""
        return orders.order_wide(self.order_info, self.lines())

    def lines(self, day: str | None = None, skus: DataFrame | None = None) -> DataFrame:
        return tables.order_detail(self.spark, self.sf_dir, day=day, with_create_time=False, skus=skus)

    def sales(self, day: str | None = None, skus: DataFrame | None = None) -> DataFrame:
        """Lines with the raw columns of their order (not yet enriched), for queries that
        choose rows first: the line's columns, ``user_id``, ``create_time``,
        ``create_date``.  A day is a pushed filter of the orders scan; of ``skus`` (one
        column), only the lines that have them are moved."""
        o = self.order_facts(day, day).select(F.col("id").alias("_order"), "user_id", "create_time", "create_date")
        li = self.lines(day, skus)
        return li.join(o, li.order_id == F.col("_order")).drop("_order")

    def product_sales(self) -> DataFrame:
        """``sku_id, sku_name, lines``: how many rows :meth:`sales` has of each product.  Two
        keys of a line are moved to its orders, and names meet the counts."""
        li = self.table("lineitem").select("l_orderkey", F.col("l_partkey").alias("sku_id"))
        keys = self.table("orders").select("o_orderkey")
        n = li.join(keys, li.l_orderkey == keys.o_orderkey).groupBy("sku_id").agg(F.count(F.lit(1)).alias("n"))
        part = self.table("part").select("p_partkey", F.col("p_name").alias("sku_name"))
        return n.join(part, n.sku_id == part.p_partkey, "left").groupBy("sku_id", "sku_name").agg(F.sum("n").alias("lines"))

    def enrich_sales(self, rows: DataFrame) -> DataFrame:
        """User and province attributes of chosen sales rows."""
        cust = self.table("customer").select(F.col("c_custkey").alias("_c"), F.col("c_nationkey").alias("province_id"))
        rows = rows.join(cust, rows.user_id == F.col("_c"), "left").drop("_c")
        rows = dims.with_user(rows, self.users, "user_id", as_of=self.as_of, key_type="long")
        return dims.with_province(rows, self.provinces, "province_id", {"province_name": "name"}, key_type="long")

    def buyer_sales(self, day: str | None = None) -> DataFrame:
        """Sales with the buyer's gender and age."""
        return dims.with_user(self.sales(day), self.users, "user_id", as_of=self.as_of, key_type="long")

    def sold_lines(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """``sku_id, split_total_amount`` of the lines that have an order (in the days)."""
        li = self.table("lineitem").select("l_orderkey", F.col("l_partkey").alias("sku_id"),
                                           F.col("l_extendedprice").alias("split_total_amount"))
        keys = self.order_facts(first, last).select(F.col("id").alias("_order"))
        return li.join(keys, li.l_orderkey == F.col("_order"), "left_semi").drop("l_orderkey")

    def order_wide_within(self, bound: str = "24 hours") -> DataFrame:
        """D8 with the streaming join's time bound; the line's event time is
        its ship date (the only line time independent of the order)."""
        o = self.order_info.withColumn("_et", F.to_timestamp("create_time"))
        d = (tables.order_detail(self.spark, self.sf_dir, with_ship_time=True, with_create_time=False)
             .withColumn("_et", F.to_timestamp("ship_time")))
        return orders.order_wide_within(o, d, "_et", "_et", bound)

    @cached_property
    def products(self) -> DataFrame:
        return tables.products(self.spark, self.sf_dir)

    @cached_property
    def app_log(self) -> DataFrame:
        return tables.app_log(self.spark, self.sf_dir)

    @cached_property
    def change_log(self) -> DataFrame:
        return tables.change_log(self.spark, self.sf_dir)

    @cached_property
    def movies(self) -> DataFrame:
        return tables.movies(self.spark, self.sf_dir)

    @cached_property
    def movie_actors(self) -> DataFrame:
        return tables.movie_actors(self.spark, self.sf_dir)

    @cached_property
    def movie_titles(self) -> DataFrame:
        return tables.movie_titles(self.spark, self.sf_dir)
