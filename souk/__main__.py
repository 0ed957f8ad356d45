"""Command line: run a stage on files.

  python -m souk clean    INPUT [OUTPUT]    cleaned listings (CSV dir; default INPUT_cleaned.csv)
  python -m souk features INPUT OUTPUT      cleaned -> featured (parquet)
  python -m souk label    INPUT OUTPUT      featured -> labelled (parquet)
  python -m souk report   INPUT OUTDIR      labelled -> one CSV dir per chart dataset
  python -m souk ingest   LANDING OUTPUT    landing pages (JSON Lines) -> listing rows (parquet)
  python -m souk run      LANDING OUTDIR    all stages from landing pages

INPUT may be .json / .jsonl (JSON Lines), .csv or .parquet; --multi-line reads a JSON
array a file, or CSV fields that span lines (such files are read by one task each).
An output that is, holds or lies in the input is refused.  The session is the one
spark-submit describes; its master and settings are left as they are.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import SparkSession

RUN_TS_FORMAT = "%Y-%m-%d %H:%M:%S"


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from souk.session import submitted_session
    return submitted_session()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="souk", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    ap.add_argument("stage", choices=["clean", "features", "label", "report", "ingest", "run"])
    ap.add_argument("input")
    ap.add_argument("output", nargs="?")
    ap.add_argument("--run-ts", default=None, help="clean timestamp (default: now)")
    ap.add_argument("--order-by", default=None, help="comma-separated input order columns for keep-first dedup")
    ap.add_argument("--multi-line", action="store_true", help="JSON arrays, or CSV fields that span lines")
    ap.add_argument("--stamped", action="store_true", help="ingest: add the rows under run_ts=STAMP and keep earlier runs")
    a = ap.parse_args(argv)
    run_ts = a.run_ts or datetime.now().strftime(RUN_TS_FORMAT)

    from pyspark.sql import functions as F

    from souk.operators.clean import CLEANED_DDL, clean_listings
    from souk.operators.features import add_features
    from souk.operators.labels import label_products
    from souk.operators.report import null_audit_observed
    from souk.plans.ingest import ingest, merged_listings
    from souk.plans.run import report_tables, run
    from souk.sources.categories import category_dim
    from souk.sources.files import default_output_path, read_table, refuse_overwrite, write_table
    from souk.sources.payloads import LANDING_DDL

    from souk.session import clean_scratch

    path = a.output or (default_output_path(a.input) if a.stage == "clean" else None)
    if path is None:
        ap.error(f"{a.stage} needs an OUTPUT")
    refuse_overwrite(a.input, path)
    spark = _session()
    try:
        if a.stage == "clean":
            raw = read_table(spark, a.input, multi_line=a.multi_line, text=True)
            if a.order_by:
                order = a.order_by.split(",")
            else:  # by file, place of the split in the file, and row in the split
                raw = raw.withColumns({"_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.file_block_start"),
                                       "_row": F.monotonically_increasing_id()})
                order = ["_file", "_at", "_row"]
            out, audit = null_audit_observed(clean_listings(raw, run_ts, order_by=order))
            write_table(out, path, fmt="csv")
            for column, n in audit.get.items():
                print(f"{column}: {n} missing")
            print(f"cleaned rows written to {path}")
        elif a.stage == "features":
            schema = CLEANED_DDL if a.input.rstrip("/").endswith(".csv") else None
            write_table(add_features(read_table(spark, a.input, schema=schema, multi_line=a.multi_line)), path)
        elif a.stage == "label":
            write_table(label_products(read_table(spark, a.input, multi_line=a.multi_line)), path)
        elif a.stage == "report":
            for name, df in report_tables(read_table(spark, a.input, multi_line=a.multi_line)).items():
                write_table(df, f"{path.rstrip('/')}/{name}", fmt="csv")
        elif a.stage == "ingest":
            landing = spark.read.schema(LANDING_DDL).json(a.input)
            stamp = datetime.strptime(run_ts, RUN_TS_FORMAT).strftime("%Y-%m-%d_%H-%M") if a.stamped else None
            write_table(merged_listings(ingest(landing, category_dim(spark))), path, run_ts=stamp)
        else:
            landing = spark.read.schema(LANDING_DDL).json(a.input)
            for name, df in run(landing, category_dim(spark), run_ts).items():
                write_table(df, f"{path.rstrip('/')}/{name}", fmt="parquet" if name == "labeled" else "csv")
    finally:
        clean_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
