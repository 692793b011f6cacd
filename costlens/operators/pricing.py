"""Hourly on-demand prices from landed price-list documents.

A document is a JSON string: ``product.attributes`` (instance type, location,
operating system, ...) and ``terms.OnDemand``: terms keyed by opaque ids, each
with ``priceDimensions`` keyed by opaque ids, each with a ``unit`` and a
``pricePerUnit`` map by currency. The price of an instance type is the first
dimension, in document order, whose unit is hourly and that has a USD price
(zero included).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from costlens import schemas
from costlens.constants import (
    PRICE_CURRENCY,
    PRICE_UNIT,
    PRODUCT_FILTERS,
    REGION_NAMES,
    SERVICE_CODE,
)


_CHECKED = StructType([*schemas.PRICE_DOC.fields, StructField("_bad", StringType())])


class UnknownRegionError(KeyError):
    """The region code has no price-list location name."""


def _parsed(docs: DataFrame) -> DataFrame:
    doc = F.from_json("doc", _CHECKED, {"columnNameOfCorruptRecord": "_bad"})
    readable = doc.isNotNull() & doc["_bad"].isNull() & (F.trim("doc") != "")
    return docs.select("doc_pos", "doc", doc.alias("d"), F.coalesce(readable, F.lit(False)).alias("_readable"))


def location_name(region_code: str) -> str:
    """Price-list location name of a region code; unknown codes raise."""
    try:
        return REGION_NAMES[region_code]
    except KeyError:
        raise UnknownRegionError(region_code) from None


def parse_price_list(docs: DataFrame, on_bad: str = "fail") -> DataFrame:
    """``(doc_pos, doc)`` strings -> ``doc_pos, service_code, instance_type, attributes, on_demand``.

    A document that is not JSON, or has a part of another type, fails the job;
    with ``on_bad="reject"`` it is left out (``rejected_documents`` lists it).
    """
    parsed = _parsed(docs)
    if on_bad == "reject":
        parsed = parsed.where("_readable")
    elif on_bad == "fail":
        message = F.concat(F.lit("unreadable price document at "), F.col("doc_pos").cast("string"))
        parsed = parsed.where(F.when(F.col("_readable"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    else:
        raise ValueError(f"on_bad is 'fail' or 'reject', not {on_bad!r}")
    attrs = F.col("d.product.attributes")
    return parsed.select(
        "doc_pos",
        F.col("d.serviceCode").alias("service_code"),
        attrs.getItem("instanceType").alias("instance_type"),
        attrs.alias("attributes"),
        F.col("d.terms.OnDemand").alias("on_demand"),
    )


def rejected_documents(docs: DataFrame) -> DataFrame:
    """``(doc_pos, doc)`` of the documents that cannot be read."""
    return _parsed(docs).where("not _readable").select("doc_pos", "doc")


def filter_products(parsed: DataFrame, region_code: str) -> DataFrame:
    """Keep shared-tenancy Linux instance products of the region's location.

    A document that names its service must name the instance service; one
    landed from a single-service export may leave it out.
    """
    attrs = F.col("attributes")
    service = F.col("service_code")
    cond = (service.isNull() | (service == F.lit(SERVICE_CODE))) & (
        attrs.getItem("location") == F.lit(location_name(region_code))
    )
    for field, value in PRODUCT_FILTERS.items():
        cond = cond & (attrs.getItem(field) == F.lit(value))
    return parsed.where(cond)


def hourly_prices(parsed: DataFrame) -> DataFrame:
    """Every hourly USD price dimension with its position in the document.

    Columns: instance_type, doc_pos, term_pos, dim_pos, price_text.
    Map entries keep the document's key order, so positions follow the text.
    """
    terms = parsed.select(
        "instance_type", "doc_pos", F.posexplode("on_demand").alias("term_pos", "term_id", "term")
    )
    dims = terms.select(
        "instance_type",
        "doc_pos",
        "term_pos",
        F.posexplode("term.priceDimensions").alias("dim_pos", "dim_id", "dim"),
    )
    usd = F.try_element_at(F.col("dim.pricePerUnit"), F.lit(PRICE_CURRENCY))
    return dims.where((F.col("dim.unit") == F.lit(PRICE_UNIT)) & usd.isNotNull()).select(
        "instance_type", "doc_pos", "term_pos", "dim_pos", usd.alias("price_text")
    )


def first_hourly_price(prices: DataFrame) -> DataFrame:
    """The first hourly price per instance type, in document order.

    ``min_by`` over the position struct is a partial aggregate: each task
    keeps one candidate per instance type, so a type with a huge number of
    documents is never gathered in one place. Only the chosen price is cast, so
    a malformed later one does not fail the job.
    """
    pos = F.struct("doc_pos", "term_pos", "dim_pos")
    return prices.groupBy("instance_type").agg(
        F.min_by("price_text", pos).cast("double").alias("price_per_hour")
    )
