"""Command-line jobs: ``spark-submit --py-files costlens.zip costlens/__main__.py JOB ...``
or, locally, ``python -m costlens JOB ...``.

    export  --root R --md-out A --rbfe-out B [--day-glob G] [--partition-by c1,c2] [--rejects-out R]
    prices  --docs D [--docs-format text|parquet] --types t1,t2 --out DIR --month YYYY-MM
            [--region us-east-1]
    charts  --md-fact A --rbfe-fact B --prices P --metadata M --out DIR
            [--md-mps N] [--md-system S] [--rbfe-mps N] [--rbfe-system S]

The session comes from the environment (``getOrCreate``), so cluster settings
such as ``spark.checkpoint.dir`` are those of the deployment.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from costlens.constants import MD, RBFE
from costlens.operators.enrich import with_price
from costlens.operators.reshape import sizes_of
from costlens.plans.dashboard import chart_set, resolve_selection
from costlens.plans.export import export_all
from costlens.plans.price_snapshot import price_snapshot, write_prices
from costlens.sources.pricelist import read_price_documents, read_price_documents_text
from costlens.sources.publish import publish
from costlens.sources.runs import DEFAULT_DAY_GLOB
from costlens.sources.tables import read_fact, read_metadata_documents, read_prices


def _csv(value: str | None) -> list[str]:
    return [v for v in (value or "").split(",") if v]


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="costlens")
    sub = p.add_subparsers(dest="job", required=True)

    e = sub.add_parser("export", help="run tree -> MD and RBFE facts (ZSTD Parquet)")
    e.add_argument("--root", required=True)
    e.add_argument("--md-out", required=True)
    e.add_argument("--rbfe-out", required=True)
    e.add_argument("--day-glob", default=DEFAULT_DAY_GLOB, help="day folders to read; default: all")
    e.add_argument("--partition-by", default="")
    e.add_argument("--rejects-out", help="leave unreadable files out and list them here; default: fail")

    r = sub.add_parser("prices", help="landed price-list documents -> price snapshot")
    r.add_argument("--docs", required=True)
    r.add_argument("--docs-format", choices=("text", "parquet"), default="text")
    r.add_argument("--types", required=True, help="comma-separated instance types")
    r.add_argument("--out", required=True)
    r.add_argument("--month", required=True, help="snapshot month, YYYY-MM")
    r.add_argument("--region", default="us-east-1")

    c = sub.add_parser("charts", help="facts, prices, metadata -> chart tables (Parquet)")
    c.add_argument("--md-fact", required=True)
    c.add_argument("--rbfe-fact", required=True)
    c.add_argument("--prices", required=True)
    c.add_argument("--metadata", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--md-mps", type=int)
    c.add_argument("--md-system")
    c.add_argument("--rbfe-mps", type=int)
    c.add_argument("--rbfe-system")
    return p


def run(argv: Sequence[str], spark: SparkSession) -> None:
    args = _parser().parse_args(argv)
    if args.job == "export":
        export_all(
            spark, args.root, args.md_out, args.rbfe_out,
            day_glob=args.day_glob, partition_by=_csv(args.partition_by) or None,
            rejects_out=args.rejects_out,
        )
    elif args.job == "prices":
        read_docs = read_price_documents_text if args.docs_format == "text" else read_price_documents
        wanted = spark.createDataFrame([(t,) for t in _csv(args.types)], "instance_type string")
        snap = price_snapshot(read_docs(spark, args.docs), wanted, args.region)
        month = dt.datetime.strptime(args.month, "%Y-%m").date()
        write_prices(snap, args.out, month)
    else:
        prices = read_prices(spark, args.prices)
        sizes = sizes_of(read_metadata_documents(spark, args.metadata))
        md = with_price(read_fact(spark, args.md_fact), prices).where(F.col("benchmark_type") == MD)
        rbfe = with_price(read_fact(spark, args.rbfe_fact), prices).where(F.col("benchmark_type") == RBFE)
        sel = resolve_selection(md, rbfe, args.md_mps, args.md_system, args.rbfe_mps, args.rbfe_system)
        for name, table in chart_set(md, rbfe, sel, sizes).items():
            publish(table, f"{args.out.rstrip('/')}/{name}")


def main() -> None:
    spark = SparkSession.builder.appName("costlens").getOrCreate()
    try:
        run(sys.argv[1:], spark)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
