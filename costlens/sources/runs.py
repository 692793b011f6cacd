"""Readers for the raw run tree.

Layout::

    <root>/runs/<YYYY-MM-DD>/<run_id>/manifest.json
    <root>/runs/<YYYY-MM-DD>/<run_id>/output/md_benchmark.out
    <root>/runs/<YYYY-MM-DD>/<run_id>/output/rbfe_benchmark.out

A file holds one JSON document, several in a row (one per line, or just one
after the other), or an array of them. The tree is listed once for all file
kinds (``recursiveFileLookup`` under the day folders that match ``day_glob``, a
brace glob on the file names) and read as whole-file text; each kind is then
parsed with ``from_json`` against an explicit schema. Listing is the expensive
part of many small files on an object store, so the export jobs share one
listing; Spark packs many small files into one split. What the listing sends to
the driver are the files' names and sizes, from a few tasks per core: Spark's
default of one task per folder sends several times as much.

Nothing is lost without a word: a file that is not JSON, or holds a field that
does not fit its type, fails the job (``on_bad="fail"``), or is left out and
listed by ``rejected_files`` (``on_bad="reject"``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from costlens import schemas
from costlens.constants import (
    MANIFEST_FILE,
    MANIFEST_SCHEMA_VERSION,
    MD_OUTPUT_FILE,
    RBFE_OUTPUT_FILE,
)
from costlens.functions.paths import decode_path, run_date_from_path, run_id_from_path
from costlens.session import read_tasks, settings

RUN_FILES = (MD_OUTPUT_FILE, RBFE_OUTPUT_FILE, MANIFEST_FILE)
DEFAULT_DAY_GLOB = "*-*-*"  # all day folders, of any year

# JSON options: NaN / Infinity tokens are accepted (Spark's default), kept
# explicit because the finite filter depends on seeing them.
_JSON_OPTIONS = {"allowNonNumericNumbers": "true"}


#: Where one document ends and the next begins, outside arrays and objects.
_NEXT_DOCUMENT = r"\}\s*\{"


def _listing_settings(spark: SparkSession) -> dict[str, str]:
    """Settings of a listing by few tasks: a day folder each, or parts of one where days are fewer than cores.

    A split holds files of many hosts, so their places are not asked for.
    """
    discovery = "spark.sql.sources.parallelPartitionDiscovery"
    most = {
        f"{discovery}.threshold": max(8, spark.sparkContext.defaultParallelism),
        f"{discovery}.parallelism": read_tasks(spark),
    }
    return {k: str(min(int(spark.conf.get(k)), n)) for k, n in most.items()} | {"spark.sql.sources.ignoreDataLocality": "true"}


def read_run_tree(
    spark: SparkSession,
    root: str,
    day_glob: str = DEFAULT_DAY_GLOB,
    file_names: Sequence[str] = RUN_FILES,
) -> DataFrame:
    """One row per run file: decoded ``path``, ``file_name`` and ``text``."""
    name_glob = "{" + ",".join(file_names) + "}"
    with settings(spark, _listing_settings(spark)):
        raw = (
            spark.read.option("recursiveFileLookup", "true")
            .option("pathGlobFilter", name_glob)
            .text(f"{root.rstrip('/')}/runs/{day_glob}", wholetext=True)
        )
    # A split holds about 32 small files; every task that reads some sends its metrics to the driver.
    return raw.select(
        decode_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("value").alias("text"),
    ).coalesce(read_tasks(spark))


def _with_run_keys(df: DataFrame, tail: str) -> DataFrame:
    path = F.col("path")
    return df.withColumn("run_date_text", run_date_from_path(path)).withColumn(
        "run_id", run_id_from_path(path, tail)
    )


def _documents(rows: DataFrame, schema: StructType) -> DataFrame:
    """(path, item, doc, problem): one row per document of each file; ``problem`` is NULL where it was read.

    ``item`` is the document's text.

    A file is read as an array of documents; one that is no array is made one.
    """
    text = F.trim(F.regexp_replace("text", r"^\ufeff|^\s+|\s+$", ""))
    listed = F.concat(F.lit("["), F.regexp_replace(text, _NEXT_DOCUMENT, "},{"), F.lit("]"))
    items = F.from_json(F.when(text.startswith("["), text).otherwise(listed), "array<string>", _JSON_OPTIONS)
    one = rows.select("path", F.explode_outer(items).alias("item"))
    checked = StructType([*schema.fields, StructField("_bad", StringType())])
    parsed = one.withColumn("doc", F.from_json("item", checked, {**_JSON_OPTIONS, "columnNameOfCorruptRecord": "_bad"}))
    problem = F.when(F.col("item").isNull(), F.lit("not JSON, or no document")).when(
        F.col("doc").isNull() | F.col("doc._bad").isNotNull(), F.lit("a field does not fit its type")
    )
    return parsed.select("path", "item", "doc", problem.alias("problem"))


def _readable(docs: DataFrame, on_bad: str) -> DataFrame:
    if on_bad == "reject":
        return docs.where(F.col("problem").isNull())
    if on_bad != "fail":
        raise ValueError(f"on_bad is 'fail' or 'reject', not {on_bad!r}")
    message = F.concat(F.lit("unreadable run file "), "path", F.lit(": "), "problem")
    return docs.where(F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def _output_files(tree: DataFrame, file_name: str) -> DataFrame:
    # Both predicates read only file metadata, so the scan can skip other files.
    return tree.where((F.col("file_name") == F.lit(file_name)) & F.col("path").endswith(f"/output/{file_name}"))


def _manifest_files(tree: DataFrame) -> DataFrame:
    return tree.where(F.col("file_name") == F.lit(MANIFEST_FILE))


def run_outputs(tree: DataFrame, file_name: str, schema: StructType, on_bad: str = "fail") -> DataFrame:
    """Parsed output files below an ``output/`` folder, with path-derived keys.

    Columns: path, run_date_text, run_id, then the schema's fields; one row per
    document, and all documents of a file belong to its run. Run keys are
    ``''`` when the path does not follow the layout; see ``matched_runs``.
    """
    parsed = _readable(_documents(_output_files(tree, file_name), schema), on_bad)
    keyed = _with_run_keys(parsed, f"output/{file_name}")
    return keyed.select("path", "run_date_text", "run_id", *[F.col("doc").getField(f.name).alias(f.name) for f in schema.fields])


def parse_manifests(tree: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Every manifest file, any layout version.

    Columns: path, run_date_text and run_id (``''`` when the path does not
    follow the layout), schema_version, instance_type, ami, mps_process_count.
    """
    parsed = _readable(_documents(_manifest_files(tree), schemas.MANIFEST), on_bad)
    return _with_run_keys(parsed, MANIFEST_FILE).select(
        "path",
        "run_date_text",
        "run_id",
        F.col("doc.schema_version").alias("schema_version"),
        F.col("doc.instance_type").alias("instance_type"),
        F.col("doc.ami_id").alias("ami"),
        F.col("doc.mps_process_count").alias("mps_process_count"),
    )


def rejected_files(tree: DataFrame, kinds: Mapping[str, StructType]) -> DataFrame:
    """(path, reason) of every file that ``on_bad="reject"`` leaves out, and of every file outside the layout.

    ``kinds`` gives the schema of each output file name; manifests are always
    looked at.
    """
    found = []
    for name, schema in (*kinds.items(), (MANIFEST_FILE, schemas.MANIFEST)):
        files = _manifest_files(tree) if name == MANIFEST_FILE else _output_files(tree, name)
        tail = name if name == MANIFEST_FILE else f"output/{name}"
        keyed = _with_run_keys(files.select("path"), tail)
        stray = (F.col("run_id") == "") | (F.col("run_date_text") == "")
        found.append(_documents(files, schema).where("problem is not null").select("path", F.col("problem").alias("reason")))
        found.append(keyed.where(stray).select("path", F.lit("no run date or run id in the path").alias("reason")))
    return reduce(DataFrame.unionByName, found).distinct()


def key_counts(tree: DataFrame, kinds: Mapping[str, StructType]) -> DataFrame:
    """(file_name, key, documents): in how many documents of its kind each key occurs.

    Keys are those met in the documents, known or not, and those below them where
    a schema of ``kinds`` expects an object (``system.phase``). Keys are counted where the
    documents are read, before any exchange. Unreadable documents count for none.
    """
    found = []
    for name, schema in (*kinds.items(), (MANIFEST_FILE, schemas.MANIFEST)):
        files = _manifest_files(tree) if name == MANIFEST_FILE else _output_files(tree, name)
        entries = F.map_entries(F.from_json("item", "map<string,string>", _JSON_OPTIONS))
        item = _documents(files, StructType([])).where(F.col("item").isNotNull()).select(F.explode(entries).alias("e"))
        key = F.col("e.key")
        if any(isinstance(f.dataType, StructType) for f in schema.fields):
            below = F.coalesce(F.json_object_keys("e.value"), F.array().cast("array<string>"))
            key = F.explode(F.concat(F.array(key), F.transform(below, lambda k: F.concat(F.col("e.key"), F.lit("."), k))))
        found.append(item.select(F.lit(name).alias("file_name"), key.alias("key")))
    return reduce(DataFrame.unionByName, found).groupBy("file_name", "key").agg(F.count(F.lit(1)).alias("documents"))


def expected_keys(kinds: Mapping[str, StructType]) -> list[tuple[str, str]]:
    """(file_name, key) of the schemas, nested ones as ``key.key``."""
    out = []
    for name, schema in (*kinds.items(), (MANIFEST_FILE, schemas.MANIFEST)):
        for f in schema.fields:
            out.append((name, f.name))
            if isinstance(f.dataType, StructType):
                out += [(name, f"{f.name}.{g}") for g in f.dataType.fieldNames()]
    return out


def select_manifests(parsed: DataFrame, version: int = MANIFEST_SCHEMA_VERSION) -> DataFrame:
    """Manifests of one layout version with a usable run id."""
    return parsed.where(
        (F.col("schema_version") == F.lit(version)) & (F.col("run_id") != "")
    ).select("run_id", "instance_type", "ami", "mps_process_count")


def manifests(tree: DataFrame, version: int = MANIFEST_SCHEMA_VERSION, on_bad: str = "fail") -> DataFrame:
    """Run manifests of one layout version: run_id, instance_type, ami, mps_process_count.

    A run_id that appears in several manifests (e.g. under two dates) stays
    duplicated; joins then multiply rows, as in the reference.
    """
    return select_manifests(_in_layout(parse_manifests(tree, on_bad), on_bad), version)


def unmatched_paths(df: DataFrame) -> DataFrame:
    """Distinct paths whose run date or run id could not be taken from the path."""
    bad = (F.col("run_id") == "") | (F.col("run_date_text") == "")
    return df.where(bad).select("path").distinct()


def _in_layout(df: DataFrame, on_bad: str) -> DataFrame:
    good = (F.col("run_id") != "") & (F.col("run_date_text") != "")
    if on_bad == "fail":
        message = F.concat(F.lit("run file outside the layout: "), "path")
        good = F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return df.where(good)


def matched_runs(df: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Rows whose path gave both keys, with ``run_date`` cast to DATE.

    A file outside the layout fails the job, as an empty date does in the
    reference, or is left out (``on_bad="reject"``; see ``rejected_files``).
    """
    good = _in_layout(df, on_bad)
    return good.withColumn("run_date", F.col("run_date_text").cast("date")).drop("run_date_text", "path")
