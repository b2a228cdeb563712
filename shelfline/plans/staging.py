"""Staging projections (PRJ1-PRJ7): renames only, row count unchanged.

These are lazy views; Catalyst collapses them into the scans of whatever
model reads them and prunes the columns that model does not use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sel(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.col(src).alias(dst) for src, dst in cols])


def stg_orders(orders: DataFrame) -> DataFrame:
    return _sel(orders, [("order_id", "order_id"), ("user_id", "user_id"), ("status", "status"),
                         ("gender", "gender"), ("created_at", "created_at"),
                         ("returned_at", "returned_at"), ("shipped_at", "shipped_at"),
                         ("delivered_at", "delivered_at"), ("num_of_item", "num_of_items")])


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return _sel(order_items, [("id", "order_item_id"), ("order_id", "order_id"),
                              ("user_id", "user_id"), ("product_id", "product_id"),
                              ("inventory_item_id", "inventory_item_id"), ("status", "status"),
                              ("created_at", "created_at"), ("shipped_at", "shipped_at"),
                              ("delivered_at", "delivered_at"), ("returned_at", "returned_at"),
                              ("sale_price", "sale_price")])


def stg_products(products: DataFrame) -> DataFrame:
    return _sel(products, [("id", "product_id"), ("distribution_center_id", "distribution_center_id"),
                           ("name", "product_name"), ("category", "category"), ("brand", "brand"),
                           ("department", "department"), ("sku", "sku"), ("cost", "cost"),
                           ("retail_price", "retail_price")])


def stg_users(users: DataFrame) -> DataFrame:
    return _sel(users, [("id", "user_id"), ("first_name", "first_name"),
                        ("last_name", "last_name"), ("email", "email"), ("age", "age"),
                        ("gender", "gender"), ("state", "state"),
                        ("street_address", "street_address"), ("postal_code", "postal_code"),
                        ("city", "city"), ("country", "country"), ("latitude", "latitude"),
                        ("longitude", "longitude"), ("traffic_source", "traffic_source"),
                        ("created_at", "created_at"), ("user_geom", "user_geom")])


def stg_inventory_items(inventory_items: DataFrame) -> DataFrame:
    return _sel(inventory_items, [
        ("id", "inventory_item_id"), ("product_id", "product_id"),
        ("created_at", "created_at"), ("sold_at", "sold_at"), ("cost", "cost"),
        ("product_category", "product_category"), ("product_name", "product_name"),
        ("product_brand", "product_brand"), ("product_retail_price", "retail_price"),
        ("product_department", "product_department"), ("product_sku", "product_sku"),
        ("product_distribution_center_id", "distribution_center_id")])


def stg_distribution_centers(dcs: DataFrame) -> DataFrame:
    return _sel(dcs, [("id", "distribution_center_id"), ("name", "distribution_center_name"),
                      ("latitude", "latitude"), ("longitude", "longitude"),
                      ("distribution_center_geom", "distribution_center_geom")])


def stg_events(events: DataFrame) -> DataFrame:
    return _sel(events, [("id", "event_id"), ("user_id", "user_id"), ("session_id", "session_id"),
                         ("sequence_number", "sequence_number"), ("created_at", "created_at"),
                         ("ip_address", "ip_address"), ("city", "city"), ("state", "state"),
                         ("postal_code", "postal_code"), ("browser", "browser"),
                         ("traffic_source", "traffic_source"), ("uri", "uri"),
                         ("event_type", "event_type")])


def snapshot_projection(products: DataFrame) -> DataFrame:
    """PRJ13: the nine product columns the SCD2 snapshot tracks."""
    return _sel(products, [("id", "product_id"), ("name", "product_name"), ("category", "category"),
                           ("brand", "brand"), ("department", "department"), ("sku", "sku"),
                           ("distribution_center_id", "distribution_center_id"),
                           ("cost", "cost"), ("retail_price", "retail_price")])
