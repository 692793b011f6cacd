"""A raw run tree derived from the ``events`` table, for end-to-end export checks.

A run is one (day, event type, block of 150 user ids), so the tree grows with
the table (150 runs at sf0.01, 1,500 at sf0.1). Within a run, the eight
systems are the eight 3-hour slots of the day: MD ns/day is the slot's
largest event value; RBFE complex / solvent are the largest / smallest value. Layout quirks are driven
by the data so that every export rule is exercised:

* MD: slot 3 of ``error`` runs is NaN, slot 5 of ``signup`` runs Infinity,
  slot 7 of ``click`` runs -Infinity, slot 0 of ``view`` runs JSON null;
* RBFE: complex of slot 1 of ``signup`` runs is null, solvent of slot 2 of
  ``error`` runs NaN, solvent of ``click`` runs a quoted number;
* manifests: ``view`` runs after day 25 have layout version 3; ``purchase``
  runs up to day 5 have none; ``signup`` runs of day 1 have a second manifest
  under the next day (duplicate run id); ``error`` runs of day 15 sit one
  folder deeper (no run id can be taken from the path).

Files are written by the executors (one task per batch of files) through
Arrow's file-system layer, below a folder in the shared checkpoint location.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import lru_cache
from urllib.parse import urlparse

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.constants import DEFAULT_SYSTEMS
from costlens.plans import adapter
from costlens.session import scratch_dir

USERS_PER_RUN = 150


def _filesystem(root: str):
    from pyarrow import fs as pafs

    if root.startswith("file:"):
        return pafs.LocalFileSystem(), urlparse(root).path
    if root.startswith(("s3a:", "s3n:")):
        root = "s3" + root[3:]
    if "://" not in root:
        return pafs.LocalFileSystem(), root
    return pafs.FileSystem.from_uri(root)


def write_files(files: DataFrame, root: str) -> int:
    """Write each ``(rel_path, text)`` row to ``<root>/<rel_path>``; returns the count.

    The task function is shipped by value, so Python workers need no
    installed copy of this package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _filesystem(root)
        made: set[str] = set()
        for pdf in batches:
            for rel, text in zip(pdf["rel_path"], pdf["text"]):
                full = f"{base.rstrip('/')}/{rel}"
                parent = full.rsplit("/", 1)[0]
                if parent not in made:
                    fs.create_dir(parent, recursive=True)
                    made.add(parent)
                with fs.open_output_stream(full) as out:
                    out.write(text.encode("utf-8"))
            yield pd.DataFrame({"written": [len(pdf)]})

    done = files.mapInPandas(write, "written long").agg(F.sum("written").alias("n")).first()
    return int(done["n"] or 0)


def _cells(spark: SparkSession, sf_dir: str, systems: Sequence[str]) -> DataFrame:
    ev = adapter.table(spark, sf_dir, "events")
    slot = F.floor(F.hour("ts") / 3).cast("int")
    group = F.floor(F.col("user_id") / USERS_PER_RUN).cast("bigint")
    cells = ev.groupBy(
        F.to_date("ts").alias("d"), F.col("event_type").alias("et"), group.alias("g"), slot.alias("b")
    ).agg(F.max("value").alias("vmax"), F.min("value").alias("vmin"))
    names = F.array(*[F.lit(s) for s in systems])
    return cells.withColumn("system", F.element_at(names, F.col("b") + 1))


def run_files(spark: SparkSession, sf_dir: str, systems: Sequence[str] = DEFAULT_SYSTEMS) -> DataFrame:
    """The tree as ``(rel_path, text)`` rows, built from ``events``."""
    cells = _cells(spark, sf_dir, systems)
    et, b = F.col("et"), F.col("b")
    num = lambda c: F.col(c).cast("string")  # noqa: E731 - Spark's text of a double round-trips
    md_value = (
        F.when((et == "error") & (b == 3), F.lit("NaN"))
        .when((et == "signup") & (b == 5), F.lit("Infinity"))
        .when((et == "click") & (b == 7), F.lit("-Infinity"))
        .when((et == "view") & (b == 0), F.lit("null"))
        .otherwise(num("vmax"))
    )
    complex_v = F.when((et == "signup") & (b == 1), F.lit("null")).otherwise(num("vmax"))
    solvent_v = (
        F.when((et == "error") & (b == 2), F.lit("NaN"))
        .when(et == "click", F.concat(F.lit('"'), num("vmin"), F.lit('"')))
        .otherwise(num("vmin"))
    )
    key = F.concat(F.lit('"'), F.col("system"), F.lit('": '))
    entries = cells.select(
        "d",
        "et",
        "g",
        F.concat(key, md_value).alias("md"),
        F.concat(key, F.lit('{"complex": '), complex_v, F.lit(', "solvent": '), solvent_v, F.lit("}")).alias(
            "rbfe"
        ),
    )
    # At most one entry per system per run: a bounded list.
    runs = entries.groupBy("d", "et", "g").agg(
        F.concat(F.lit("{"), F.concat_ws(", ", F.sort_array(F.collect_list("md"))), F.lit("}")).alias("md_doc"),
        F.concat(F.lit("{"), F.concat_ws(", ", F.sort_array(F.collect_list("rbfe"))), F.lit("}")).alias(
            "rbfe_doc"
        ),
    )
    day = F.dayofmonth("d")
    run_id = F.concat(
        F.col("et"), F.lit("-"), F.date_format("d", "yyyyMMdd"), F.lit("-"), F.col("g").cast("string")
    )
    nested = (F.col("et") == "error") & (day == 15)
    run_dir = F.concat(
        F.lit("runs/"),
        F.date_format("d", "yyyy-MM-dd"),
        F.when(nested, F.lit("/extra")).otherwise(F.lit("")),
        F.lit("/"),
        run_id,
    )

    def manifest(version, instance, ami, mps):
        return F.concat(
            F.lit('{"schema_version": '), version.cast("string"),
            F.lit(', "instance_type": "'), instance,
            F.lit('", "ami_id": "'), ami,
            F.lit('", "mps_process_count": '), mps.cast("string"), F.lit("}"),
        )

    et = F.col("et")
    mps = (
        F.when(et == "click", 1).when(et == "view", 2).when(et == "signup", 4)
        .when(et == "purchase", 8).otherwise(1)
    )
    instance = (
        F.when(day <= 10, F.lit("g4dn.xlarge")).when(day <= 20, F.lit("g5.xlarge"))
        .otherwise(F.lit("g6e.xlarge"))
    )
    version = F.when((et == "view") & (day > 25), F.lit(3)).otherwise(F.lit(4))
    has_manifest = ~((et == "purchase") & (day <= 5))
    copy_dir = F.concat(
        F.lit("runs/"), F.date_format(F.date_add("d", 1), "yyyy-MM-dd"), F.lit("/"), run_id
    )
    files = F.array(
        F.struct(F.concat(run_dir, F.lit("/output/md_benchmark.out")).alias("rel_path"), F.col("md_doc").alias("text")),
        F.struct(F.concat(run_dir, F.lit("/output/rbfe_benchmark.out")).alias("rel_path"), F.col("rbfe_doc").alias("text")),
        F.struct(
            F.concat(run_dir, F.lit("/manifest.json")).alias("rel_path"),
            F.when(has_manifest, manifest(version, instance, F.concat(F.lit("ami-"), et), mps)).alias("text"),
        ),
        F.struct(
            F.concat(copy_dir, F.lit("/manifest.json")).alias("rel_path"),
            F.when(
                (et == "signup") & (day == 1),
                manifest(F.lit(4), F.lit("g5.xlarge"), F.lit("ami-copy"), mps),
            ).alias("text"),
        ),
    )
    beside = lambda suffix, name: F.concat(run_dir, F.lit(f"-{suffix}/{name}"))
    plain = manifest(F.lit(4), instance, F.concat(F.lit("ami-"), et), mps)
    is_run = lambda kind, on: (et == kind) & (day == on)
    odd = [
        (beside("list", "manifest.json"), is_run("view", 12), plain),
        (beside("list", "output/md_benchmark.out"), is_run("view", 12), F.concat(F.lit("[\n"), F.col("md_doc"), F.lit("]"))),
        (beside("twice", "manifest.json"), is_run("view", 12), plain),
        (beside("twice", "output/md_benchmark.out"), is_run("view", 12), F.concat_ws("\n", "md_doc", "md_doc")),
        (beside("cut", "manifest.json"), is_run("purchase", 20), plain),
        (beside("cut", "output/md_benchmark.out"), is_run("purchase", 20), F.expr("left(md_doc, length(md_doc) - 3)")),
        (beside("typed", "manifest.json"), is_run("click", 20), F.replace(plain, F.lit(': 4,'), F.lit(': 4.0,'))),
        (beside("quoted", "manifest.json"), is_run("signup", 20), F.regexp_replace(plain, r"(\d+)\}$", '"$1"}')),
        (beside("quoted", "output/rbfe_benchmark.out"), is_run("signup", 20), F.lit("no benchmark today")),
    ]
    more = [F.struct(rel.alias("rel_path"), F.when(where, text).alias("text")) for rel, where, text in odd]
    return runs.select(F.inline(F.concat(files, F.array(*more)))).where(F.col("text").isNotNull())


@lru_cache(maxsize=16)
def tree_for(spark: SparkSession, sf_dir: str) -> str:
    """Write the derived tree once per session and table folder; returns its root."""
    root = scratch_dir(spark, "runs")
    write_files(run_files(spark, sf_dir), root)
    return root


# Expected facts, as SQL over the driver tables (DuckDB dialect).
_SQL_BASE = """
WITH cells AS (
  SELECT CAST(ts AS DATE) AS d, event_type AS et, CAST(floor(user_id / 150) AS BIGINT) AS g,
         CAST(hour(ts) // 3 AS INTEGER) AS b, max(value) AS vmax, min(value) AS vmin
  FROM events GROUP BY 1, 2, 3, 4),
runs AS (SELECT DISTINCT d, et, g FROM cells),
man AS (
  SELECT et || '-' || strftime(d, '%Y%m%d') || '-' || CAST(g AS VARCHAR) AS run_id,
         CAST(CASE et WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 4
                      WHEN 'purchase' THEN 8 ELSE 1 END AS BIGINT) AS mps_process_count,
         CASE WHEN day(d) <= 10 THEN 'g4dn.xlarge' WHEN day(d) <= 20 THEN 'g5.xlarge'
              ELSE 'g6e.xlarge' END AS instance_type,
         'ami-' || et AS ami
  FROM runs
  WHERE NOT (et = 'view' AND day(d) > 25) AND NOT (et = 'purchase' AND day(d) <= 5)
    AND NOT (et = 'error' AND day(d) = 15)
  UNION ALL
  SELECT et || '-' || strftime(d, '%Y%m%d') || '-' || CAST(g AS VARCHAR),
         CAST(CASE et WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 4
                      WHEN 'purchase' THEN 8 ELSE 1 END AS BIGINT),
         'g5.xlarge', 'ami-copy'
  FROM runs WHERE et = 'signup' AND day(d) = 1
  UNION ALL
  SELECT et || '-' || strftime(d, '%Y%m%d') || '-' || CAST(g AS VARCHAR) || suffix, 2, 'g5.xlarge', 'ami-view'
  FROM runs, (VALUES ('-list'), ('-twice')) AS f(suffix) WHERE et = 'view' AND day(d) = 12),
slots AS (
  SELECT d, et, g, b, {systems}[b + 1] AS system, vmax, vmin FROM cells
  WHERE NOT (et = 'error' AND day(d) = 15))
"""


def expected_md_sql(systems: Sequence[str] = DEFAULT_SYSTEMS) -> str:
    names = "[" + ", ".join(f"'{s}'" for s in systems) + "]"
    return _SQL_BASE.format(systems=names) + """
SELECT 'md' AS benchmark_type, m.mps_process_count, s.d AS run_date,
       s.run_id, s.system, CAST(NULL AS VARCHAR) AS phase,
       'ns_per_day' AS metric_name, s.vmax AS metric_value, m.instance_type, m.ami
FROM (SELECT slots.*, et || '-' || strftime(d, '%Y%m%d') || '-' || CAST(g AS VARCHAR) || suffix AS run_id
      FROM slots, (VALUES (''), ('-list'), ('-twice'), ('-twice')) AS f(suffix)
      WHERE suffix = '' OR (et = 'view' AND day(d) = 12)) s
JOIN man m ON m.run_id = s.run_id
WHERE NOT ((s.et = 'error' AND s.b = 3) OR (s.et = 'signup' AND s.b = 5)
        OR (s.et = 'click' AND s.b = 7) OR (s.et = 'view' AND s.b = 0))
  AND isfinite(s.vmax)
"""


def expected_rbfe_sql(systems: Sequence[str] = DEFAULT_SYSTEMS) -> str:
    names = "[" + ", ".join(f"'{s}'" for s in systems) + "]"
    return _SQL_BASE.format(systems=names) + """,
cells2 AS (
  SELECT d, et, g, system, 'complex' AS phase,
         CASE WHEN et = 'signup' AND b = 1 THEN NULL ELSE vmax END AS v FROM slots
  UNION ALL
  SELECT d, et, g, system, 'solvent',
         CASE WHEN et = 'error' AND b = 2 THEN 'NaN'::DOUBLE ELSE vmin END FROM slots)
SELECT 'rbfe' AS benchmark_type, m.mps_process_count, c.d AS run_date,
       c.et || '-' || strftime(c.d, '%Y%m%d') || '-' || CAST(c.g AS VARCHAR) AS run_id, c.system, c.phase,
       'ns_per_day' AS metric_name, c.v AS metric_value, m.instance_type, m.ami
FROM cells2 c JOIN man m ON m.run_id = c.et || '-' || strftime(c.d, '%Y%m%d') || '-' || CAST(c.g AS VARCHAR)
WHERE isfinite(c.v)
"""


_RUNS_SQL = """
WITH runs AS (SELECT DISTINCT CAST(ts AS DATE) AS d, event_type AS et,
                              CAST(floor(user_id / 150) AS BIGINT) AS g FROM events),
dirs AS (SELECT et, day(d) AS day, 'runs/' || strftime(d, '%Y-%m-%d') || '/' AS folder,
                et || '-' || strftime(d, '%Y%m%d') || '-' || CAST(g AS VARCHAR) AS run_id FROM runs)
"""

EXPECTED_UNMATCHED_SQL = _RUNS_SQL + """
SELECT folder || 'extra/' || run_id || '/' || name AS rel_path
FROM dirs, (VALUES ('output/md_benchmark.out'), ('output/rbfe_benchmark.out'), ('manifest.json')) AS f(name)
WHERE et = 'error' AND day = 15
"""

EXPECTED_REJECTED_SQL = _RUNS_SQL + """
SELECT folder || 'extra/' || run_id || '/' || name AS rel_path, 'no run date or run id in the path' AS reason
FROM dirs, (VALUES ('output/md_benchmark.out'), ('output/rbfe_benchmark.out'), ('manifest.json')) AS f(name)
WHERE et = 'error' AND day = 15
UNION ALL
SELECT folder || run_id || '-cut/output/md_benchmark.out', 'not JSON, or no document' FROM dirs WHERE et = 'purchase' AND day = 20
UNION ALL
SELECT folder || run_id || '-typed/manifest.json', 'a field does not fit its type' FROM dirs WHERE et = 'click' AND day = 20
UNION ALL
SELECT folder || run_id || '-quoted/manifest.json', 'a field does not fit its type' FROM dirs WHERE et = 'signup' AND day = 20
UNION ALL
SELECT folder || run_id || '-quoted/output/rbfe_benchmark.out', 'not JSON, or no document' FROM dirs WHERE et = 'signup' AND day = 20
"""

#: Documents per kind of file and key. ``files`` has the kinds of run folder with how many documents each holds.
KEYS_SQL = _SQL_BASE.format(systems="[" + ", ".join(f"'{s}'" for s in DEFAULT_SYSTEMS) + "]").replace(
    """
  WHERE NOT (et = 'error' AND day(d) = 15))""",
    ")",
) + """, md_copies AS (
  SELECT s.system AS key, 1 + CASE WHEN et = 'view' AND day(d) = 12 THEN 3 ELSE 0 END AS n FROM slots s),
manifests AS (
  SELECT CASE WHEN et = 'purchase' AND day(d) <= 5 THEN 0 ELSE 1 END + CASE WHEN et = 'signup' AND day(d) = 1 THEN 1 ELSE 0 END
         + CASE WHEN et = 'view' AND day(d) = 12 THEN 2 ELSE 0 END
         + CASE WHEN day(d) = 20 AND et IN ('purchase', 'click', 'signup') THEN 1 ELSE 0 END AS n FROM runs),
met AS (
  SELECT 'md_benchmark.out' AS file_name, key, CAST(sum(n) AS BIGINT) AS documents FROM md_copies GROUP BY key
  UNION ALL
  SELECT 'rbfe_benchmark.out', system || p, count(*) FROM slots, (VALUES (''), ('.complex'), ('.solvent')) AS v(p) GROUP BY 2
  UNION ALL
  SELECT 'manifest.json', unnest(['schema_version', 'instance_type', 'ami_id', 'mps_process_count']), CAST(sum(n) AS BIGINT) FROM manifests)
"""

EXPECTED_DUPLICATE_MANIFESTS_SQL = """
WITH runs AS (SELECT DISTINCT CAST(ts AS DATE) AS d, event_type AS et,
                              CAST(floor(user_id / 150) AS BIGINT) AS g FROM events)
SELECT et || '-' || strftime(d, '%Y%m%d') || '-' || CAST(g AS VARCHAR) AS run_id,
       CAST(2 AS BIGINT) AS rows
FROM runs WHERE et = 'signup' AND day(d) = 1
"""
