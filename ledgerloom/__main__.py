"""Command line: run the monthly job.

    python -m ledgerloom [--settings settings.yaml] [--year 2025] [--month 3]
                         [--in-dir DIR] [--out-dir DIR] [--db-path DIR]
                         [--csv-sep ;] [--csv-encoding utf-8] [--csv-float-format %.2f]
                         [--grain line|order] [--layout daily_files|month_partitions]
                         [--master local[*]]

Settings come from the defaults, then the YAML file (if present), then
the command line. Prints the quality counters as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from ledgerloom.plans.month_job import run_month
from ledgerloom.schemas import DEFAULT_MONTH, DEFAULT_SETTINGS, DEFAULT_YEAR


def load_settings(path: str | None) -> dict:
    cfg = dict(DEFAULT_SETTINGS)
    if path and os.path.exists(path):
        try:
            import yaml
        except ImportError as e:  # pragma: no cover - optional dependency
            raise SystemExit(f"reading {path} needs PyYAML: {e}")
        with open(path, encoding="utf-8") as f:
            cfg.update(yaml.safe_load(f) or {})
    return cfg


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="ledgerloom", description="Monthly sales job")
    ap.add_argument("--settings", default="settings.yaml")
    ap.add_argument("--year", type=int, default=DEFAULT_YEAR)
    ap.add_argument("--month", type=int, default=DEFAULT_MONTH)
    for key in DEFAULT_SETTINGS:
        ap.add_argument("--" + key.replace("_", "-").replace("input-dir", "in-dir").replace("output-dir", "out-dir"), dest=key)
    ap.add_argument("--grain", default="line", choices=["line", "order"])
    ap.add_argument("--layout", default="daily_files", choices=["daily_files", "month_partitions"])
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    cfg = load_settings(args.settings)
    cfg.update({k: getattr(args, k) for k in DEFAULT_SETTINGS if getattr(args, k) is not None})

    builder = SparkSession.builder.appName("ledgerloom-month")
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()
    counters = run_month(
        spark,
        cfg["input_dir"],
        cfg["output_dir"],
        args.year,
        args.month,
        layout=args.layout,
        grain=args.grain,
        sep=cfg["csv_sep"],
        encoding=cfg["csv_encoding"],
        float_format=cfg["csv_float_format"],
        warehouse=cfg["db_path"],
    )
    print(json.dumps(counters, sort_keys=True))
    return counters


if __name__ == "__main__":
    main()
