"""Key look-ups on large tables (N14, N15, N21): a small batch of orders reads only the row groups that hold them.

Loaded tables are sorted by the key that jobs look them up by, in ranges, with a Parquet bloom filter on it. A batch of few
orders then filters its tables by the ids themselves: as literals they reach the scan, where a row group is skipped if its
range or its bloom filter rules out every id. A join alone would read whole tables, as its keys are not known to the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ordercraft.sources.binding import Tables

# The key that each table is looked up by.
KEYS = {
    "dcspp_order": "order_id", "oe_order": "order_id", "nt_order": "order_id", "dcspp_order_item": "order_id",
    "dcspp_pay_group": "order_ref", "dcspp_ship_group": "order_ref", "dcspp_item": "commerce_item_id",
    "dcspp_item_price": "amount_info_id", "dcspp_order_price": "amount_info_id", "dcspp_amtinfo_adj": "amount_info_id",
    "dcspp_price_adjust": "adjustment_id", "oe_pay_group": "payment_group_id", "nt_ship_group": "shipping_group_id", "dps_user": "id",
}
MOST_IDS = 500  # ids that are sent to the scans; larger batches are joined
IN_VALUES = 10  # values of one IN that the Parquet reader tests one by one


def write_clustered(df: DataFrame, name: str, path: str, files: int | None = None, **options: str) -> None:
    """Write table ``name`` sorted by its key in ranges (``files`` of them, by default as many as shuffles have), with a bloom filter."""
    key = KEYS.get(name)
    writer = df.write.options(**options)
    if key:
        ranged = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
        writer = ranged.sortWithinPartitions(key).write.options(**options).option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.mode("errorifexists").parquet(path)


def key_in(column: str, values: list[str]) -> Column:
    """``column IN (values)`` in parts that the Parquet reader takes as they are."""
    parts = [F.col(column).isin(*values[i:i + IN_VALUES]) for i in range(0, len(values), IN_VALUES)]
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


def few(ids: DataFrame, most: int = MOST_IDS) -> list[str] | None:
    """The distinct non-NULL values of a one-column table, or None if there are more than ``most``."""
    got = ids.where(F.col(ids.columns[0]).isNotNull()).distinct().limit(most + 1).collect()
    return None if len(got) > most else sorted(r[0] for r in got)


def of_orders(t: Tables, orders: list[str]) -> Tables:
    """``t`` with the orders' tables cut down to ``orders``, by filters that the scans can use; other tables stay whole.

    Items are cut down likewise if the orders have few lines.
    """
    names = ("dcspp_order", "nt_order", "dcspp_pay_group", "dcspp_order_item")
    out = t.replace(**{name: t[name].where(key_in(KEYS[name], orders)) for name in names})
    items = few(out.dcspp_order_item.select("commerce_items"))
    return out if items is None else out.replace(dcspp_item=t.dcspp_item.where(key_in("commerce_item_id", items)))
