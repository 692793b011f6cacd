"""Price-list documents derived from ``supplier``, for end-to-end checks.

Each supplier is an instance type with up to three documents at positions
``3 * s_suppkey + slot``. With n = s_nationkey and a = s_acctbal:

* slot 0 (decoys, never matching us-east-1): 13 <= n < 16 dedicated tenancy
  at 999; 16 <= n < 19 location US West (Oregon) at a + 1; 19 <= n < 21 a
  database-service product at 777; n = 21 another operating system, n = 22
  preinstalled software, n = 23 unused capacity, at 555 each;
* slot 1, main document (absent when n = 24):
  a <= 0 -> no on-demand terms; n < 5 -> a 'Quantity' dimension, then hourly a;
  n < 10 -> first term priced only in CNY, second term hourly 2a;
  n < 13 -> hourly "0.0000000000"; else two hourly dimensions whose ids sort
  against document order, a then a + 1;
* slot 2 (only when a <= 0 and n != 24): hourly |a|.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.constants import REGION_NAMES
from costlens.plans import adapter


def _q(s: str) -> str:
    return '"' + s + '"'


def _doc(
    name: Column,
    location: Column,
    tenancy: Column,
    on_demand: Column | None,
    service: str | None = None,
    system: str = "Linux",
    software: str = "NA",
    capacity: str = "Used",
) -> Column:
    head = "{" if service is None else '{"serviceCode": ' + _q(service) + ", "
    attrs = F.concat(
        F.lit(head + '"product": {"attributes": {"instanceType": "'), name,
        F.lit('", "location": "'), location,
        F.lit(f'", "operatingSystem": "{system}", "preInstalledSw": "{software}", "capacitystatus": "{capacity}", "tenancy": "'),
        tenancy, F.lit('"}}, "terms": {'),
    )
    terms = F.lit("") if on_demand is None else F.concat(F.lit('"OnDemand": {'), on_demand, F.lit("}"))
    return F.concat(attrs, terms, F.lit("}}"))


def _dim(key: str, unit: str, currency: str, price: Column) -> Column:
    return F.concat(
        F.lit(f'{_q(key)}: {{"unit": {_q(unit)}, "pricePerUnit": {{{_q(currency)}: "'),
        price,
        F.lit('"}}'),
    )


def _term(key: str, *dims: Column) -> Column:
    body = [F.lit(f'{_q(key)}: {{"priceDimensions": {{')]
    for i, d in enumerate(dims):
        if i:
            body.append(F.lit(", "))
        body.append(d)
    body.append(F.lit("}}"))
    return F.concat(*body)


def price_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_pos, doc)`` rows built from ``supplier``."""
    s = adapter.table(spark, sf_dir, "supplier")
    n, a, name = F.col("s_nationkey"), F.col("s_acctbal"), F.col("s_name")
    txt = lambda c: c.cast("string")  # noqa: E731 - round-trips exactly
    east = F.lit(REGION_NAMES["us-east-1"])
    west = F.lit(REGION_NAMES["us-west-2"])
    shared, dedicated = F.lit("Shared"), F.lit("Dedicated")

    decoy = (
        F.when((n >= 13) & (n < 16), _doc(name, east, dedicated, _term("T0", _dim("D0", "Hrs", "USD", F.lit("999")))))
        .when((n >= 16) & (n < 19), _doc(name, west, shared, _term("T0", _dim("D0", "Hrs", "USD", txt(a + 1)))))
        .when(
            (n >= 19) & (n < 21),
            _doc(name, east, shared, _term("T0", _dim("D0", "Hrs", "USD", F.lit("777"))), "AmazonRDS"),
        )
    )
    other = _term("T0", _dim("D0", "Hrs", "USD", F.lit("555")))
    for nation, odd in ((21, {"system": "Windows"}), (22, {"software": "SQL Ent"}), (23, {"capacity": "UnusedCapacityReservation"})):
        decoy = decoy.when(n == nation, _doc(name, east, shared, other, **odd))
    main_terms = (
        F.when(n < 5, _term("T1", _dim("D1", "Quantity", "USD", F.lit("1.0")), _dim("D2", "Hrs", "USD", txt(a))))
        .when(
            n < 10,
            F.concat(
                _term("T1", _dim("D1", "Hrs", "CNY", txt(a))),
                F.lit(", "),
                _term("T2", _dim("D9", "Hrs", "USD", txt(a * 2))),
            ),
        )
        .when(n < 13, _term("T1", _dim("D1", "Hrs", "USD", F.lit("0.0000000000"))))
        .otherwise(_term("T1", _dim("Z9", "Hrs", "USD", txt(a)), _dim("A1", "Hrs", "USD", txt(a + 1))))
    )
    main = F.when(n == 24, F.lit(None)).when(a <= 0, _doc(name, east, shared, None)).otherwise(
        _doc(name, east, shared, main_terms, "AmazonEC2")
    )
    fallback = F.when((a <= 0) & (n != 24), _doc(name, east, shared, _term("T1", _dim("D1", "Hrs", "USD", txt(F.abs(a))))))
    base = F.col("s_suppkey") * 3
    docs = F.array(
        F.struct(base.alias("doc_pos"), decoy.alias("doc")),
        F.struct((base + 1).alias("doc_pos"), main.alias("doc")),
        F.struct((base + 2).alias("doc_pos"), fallback.alias("doc")),
    )
    return s.select(F.inline(docs)).where(F.col("doc").isNotNull())


def wanted_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("instance_type"))


EXPECTED_EAST_SQL = """
SELECT s_name AS instance_type,
       CASE WHEN s_nationkey = 24 THEN NULL
            WHEN s_acctbal <= 0 THEN abs(s_acctbal)
            WHEN s_nationkey < 5 THEN s_acctbal
            WHEN s_nationkey < 10 THEN s_acctbal * 2
            WHEN s_nationkey < 13 THEN 0.0
            ELSE s_acctbal END AS price_per_hour
FROM supplier
"""

EXPECTED_WEST_SQL = """
SELECT s_name AS instance_type,
       CASE WHEN s_nationkey >= 16 AND s_nationkey < 19 THEN s_acctbal + 1 END AS price_per_hour
FROM supplier
"""
