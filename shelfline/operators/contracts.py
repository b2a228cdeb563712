"""Enforced schema contracts (SNK10 / DQ12).

``enforce`` compares names first (missing *and* extra columns fail; Spark's
``df.to(schema)`` alone would silently drop extras), then exact types (no
silent widening), and guards the not-null columns with an in-plan
``raise_error`` so a violating row fails the job that writes it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[tuple[str, T.DataType, bool], ...]  # (name, type, not_null)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, not nn) for n, t, nn in self.columns])


def violations(df: DataFrame, contract: Contract) -> list[str]:
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {n: t for n, t, _ in contract.columns}
    out = [f"missing column {c}" for c in want if c not in have]
    out += [f"unexpected column {c}" for c in have if c not in want]
    out += [f"column {c}: type {have[c].simpleString()} != {t.simpleString()}"
            for c, t in want.items() if c in have and have[c] != t]
    return out


def enforce(df: DataFrame, contract: Contract, check_not_null: bool = True) -> DataFrame:
    bad = violations(df, contract)
    if bad:
        raise ContractError(f"{contract.name}: " + "; ".join(bad))
    cols = []
    for n, _, nn in contract.columns:
        c = F.col(n)
        if nn and check_not_null:
            c = F.coalesce(c, F.raise_error(F.lit(f"{contract.name}: null in not-null column {n}")))
        cols.append(c.alias(n))
    return df.select(*cols)


L, S, D, DT, TS = T.LongType(), T.StringType(), T.DoubleType(), T.DateType(), T.TimestampNTZType()

DIM_PRODUCTS = Contract("dim_products", (
    ("product_id", L, True), ("distribution_center_id", L, False), ("product_name", S, False),
    ("category", S, False), ("brand", S, False), ("department", S, False), ("sku", S, False),
    ("cost", D, True), ("retail_price", D, True), ("base_margin_amount", D, False),
    ("base_margin_pct", D, False)))

FCT_ORDER_ITEMS = Contract("fct_order_items", (
    ("order_item_id", L, True), ("order_id", L, True), ("user_id", L, False),
    ("product_id", L, True), ("distribution_center_id", L, False), ("inventory_item_id", L, False),
    ("order_date", DT, True), ("status", S, False), ("ordered_at", TS, False),
    ("shipped_at", TS, False), ("delivered_at", TS, False), ("returned_at", TS, False),
    ("sale_price", D, False), ("cost", D, False), ("gross_margin_amount", D, False),
    ("product_cost_at_sale", D, False), ("gross_margin_at_sale", D, False)))
