"""Price snapshot job: landed documents -> (instance_type, price_per_hour)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.operators.pricing import (
    filter_products,
    first_hourly_price,
    hourly_prices,
    location_name,
    parse_price_list,
)
from costlens.sources.publish import publish
from costlens.sources.tables import read_prices


def price_snapshot(
    docs: DataFrame,
    wanted: DataFrame,
    region_code: str = "us-east-1",
) -> DataFrame:
    """One row per wanted instance type with its first hourly USD price.

    ``docs``: ``(doc_pos, doc)``; ``wanted``: a column ``instance_type``. A
    type without a qualifying price keeps its row with a NULL price. The
    region code is checked before any job runs. All documents count.
    """
    location_name(region_code)
    first = first_hourly_price(hourly_prices(filter_products(parse_price_list(docs), region_code)))
    return wanted.select("instance_type").join(first, "instance_type", "left")


def snapshot_label(month: dt.date) -> str:
    """``YYYY-MM`` of the snapshot month (an argument; no hidden clock)."""
    return month.strftime("%Y-%m")


def snapshot_month(day: Column) -> Column:
    """``snapshot_label`` of a date column."""
    return F.date_format(day, "yyyy-MM")


def write_prices(df: DataFrame, out_dir: str, month: dt.date) -> str:
    """Publish JSON Lines at ``<out_dir>/<YYYY-MM>-pricing.json`` (a folder); returns it.

    A type without a price is written with an explicit null. An older snapshot
    of the month is readable until the new one is whole.
    """
    path = f"{out_dir.rstrip('/')}/{snapshot_label(month)}-pricing.json"
    publish(df.select("instance_type", "price_per_hour"), path, "json", ignoreNullFields="false")
    return path


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Read a snapshot written by ``write_prices`` (or a one-line JSON array)."""
    return read_prices(spark, path)
