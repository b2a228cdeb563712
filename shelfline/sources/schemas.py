"""Declared schemas of the retail source tables (SRC1-SRC9).

Timestamps are wall-clock UTC and carried as TIMESTAMP_NTZ so that day and
hour arithmetic never depends on the session time zone.  Money is DECIMAL(12,2).
"""

from __future__ import annotations

from pyspark.sql import types as T

L, S, D, TS, M = T.LongType(), T.StringType(), T.DoubleType(), T.TimestampNTZType(), T.DecimalType(12, 2)


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS = {
    "orders": _s(("order_id", L), ("user_id", L), ("status", S), ("gender", S),
                 ("created_at", TS), ("shipped_at", TS), ("delivered_at", TS),
                 ("returned_at", TS), ("num_of_item", L)),
    "order_items": _s(("id", L), ("order_id", L), ("user_id", L), ("product_id", L),
                      ("inventory_item_id", L), ("status", S), ("created_at", TS),
                      ("shipped_at", TS), ("delivered_at", TS), ("returned_at", TS),
                      ("sale_price", M)),
    "products": _s(("id", L), ("distribution_center_id", L), ("name", S), ("category", S),
                   ("brand", S), ("department", S), ("sku", S), ("cost", M),
                   ("retail_price", M)),
    "users": _s(("id", L), ("first_name", S), ("last_name", S), ("email", S), ("age", L),
                ("gender", S), ("state", S), ("street_address", S), ("postal_code", S),
                ("city", S), ("country", S), ("latitude", D), ("longitude", D),
                ("traffic_source", S), ("created_at", TS), ("user_geom", S)),
    "inventory_items": _s(("id", L), ("product_id", L), ("created_at", TS), ("sold_at", TS),
                          ("cost", M), ("product_category", S), ("product_name", S),
                          ("product_brand", S), ("product_retail_price", M),
                          ("product_department", S), ("product_sku", S),
                          ("product_distribution_center_id", L)),
    "distribution_centers": _s(("id", L), ("name", S), ("latitude", D), ("longitude", D),
                               ("distribution_center_geom", S)),
    "events": _s(("id", L), ("user_id", L), ("session_id", S), ("sequence_number", L),
                 ("created_at", TS), ("ip_address", S), ("city", S), ("state", S),
                 ("postal_code", S), ("browser", S), ("traffic_source", S), ("uri", S),
                 ("event_type", S)),
    "snap_products": _s(("product_id", L), ("product_name", S), ("category", S), ("brand", S),
                        ("department", S), ("sku", S), ("distribution_center_id", L),
                        ("cost", M), ("retail_price", M), ("valid_from", TS),
                        ("valid_to", TS), ("scd_id", S)),
    "ml_forecast_demand": _s(("category", S), ("forecast_week", T.DateType()),
                             ("week_ahead", L), ("predicted_units", D),
                             ("generated_at", TS), ("model", S)),
}
