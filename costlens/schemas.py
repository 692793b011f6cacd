"""Explicit schemas for every file-based input and for the exported fact.

Explicit schemas avoid an inference pass over many small files and keep column
types stable when a file lacks a field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from costlens.constants import DEFAULT_SYSTEMS, RBFE_PHASES

# Exported long fact; column order is part of the contract.
FACT = T.StructType(
    [
        T.StructField("benchmark_type", T.StringType()),
        T.StructField("mps_process_count", T.LongType()),
        T.StructField("run_date", T.DateType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("system", T.StringType()),
        T.StructField("phase", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("instance_type", T.StringType()),
        T.StructField("ami", T.StringType()),
    ]
)

FACT_COLUMNS = tuple(FACT.fieldNames())

PRICES = T.StructType(
    [
        T.StructField("instance_type", T.StringType()),
        T.StructField("price_per_hour", T.DoubleType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("schema_version", T.LongType()),
        T.StructField("instance_type", T.StringType()),
        T.StructField("ami_id", T.StringType()),
        T.StructField("mps_process_count", T.LongType()),
    ]
)

SIZES = T.StructType(
    [
        T.StructField("system", T.StringType()),
        T.StructField("total_system_size", T.LongType()),
    ]
)


def md_output(systems: Sequence[str] = DEFAULT_SYSTEMS) -> T.StructType:
    """One MD run file: one metric per system.

    Leaves are read as STRING and cast later, so quoted numbers and the
    non-numeric tokens NaN / Infinity survive the JSON reader.
    """
    return T.StructType([T.StructField(s, T.StringType()) for s in systems])


def rbfe_output(
    systems: Sequence[str] = DEFAULT_SYSTEMS, phases: Sequence[str] = RBFE_PHASES
) -> T.StructType:
    """One RBFE run file: per system an object with one leaf per phase."""
    leaf = T.StructType([T.StructField(p, T.StringType()) for p in phases])
    return T.StructType([T.StructField(s, leaf) for s in systems])


def _phase_counts() -> T.StructType:
    return T.StructType(
        [T.StructField("complex", T.LongType()), T.StructField("solvent", T.LongType())]
    )


SYSTEM_ENTRY = T.StructType(
    [
        T.StructField("edge", T.StringType()),
        T.StructField("protein", T.StringType()),
        T.StructField("atoms", _phase_counts()),
        T.StructField("waters", _phase_counts()),
    ]
)


#: A metadata document of any systems.
METADATA_DOCUMENT = T.MapType(T.StringType(), SYSTEM_ENTRY)


def system_metadata(systems: Sequence[str] = DEFAULT_SYSTEMS) -> T.StructType:
    """The system metadata document: one struct column per system."""
    return T.StructType([T.StructField(s, SYSTEM_ENTRY) for s in systems])


# A landed price-list document: product attributes plus on-demand terms keyed
# by opaque ids. Maps keep the document's key order when exploded.
_PRICE_DIMENSION = T.StructType(
    [
        T.StructField("unit", T.StringType()),
        T.StructField("pricePerUnit", T.MapType(T.StringType(), T.StringType())),
    ]
)
_TERM = T.StructType(
    [T.StructField("priceDimensions", T.MapType(T.StringType(), _PRICE_DIMENSION))]
)
PRICE_DOC = T.StructType(
    [
        T.StructField("serviceCode", T.StringType()),
        T.StructField(
            "product",
            T.StructType(
                [T.StructField("attributes", T.MapType(T.StringType(), T.StringType()))]
            ),
        ),
        T.StructField(
            "terms",
            T.StructType([T.StructField("OnDemand", T.MapType(T.StringType(), _TERM))]),
        ),
    ]
)
