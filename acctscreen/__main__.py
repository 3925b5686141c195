"""Daily run from the command line (under ``spark-submit`` or ``python -m``).

    spark-submit --py-files acctscreen.zip acctscreen/__main__.py \\
        --snap-date 2024-01-31 --root hdfs:///screening --tables tables.json [--stages 1,2,3]

or ``python -m acctscreen ...`` where a session can be built locally.

``tables.json`` maps the input names of ``TableNames`` (``savings_txn``,
``customers``, ``account_flags``, ``brokerage_links``, ``mobile_log``, ``web_log``, ``account_snapshot``,
optionally ``registered``) to metastore tables, Parquet paths or objects of
JDBC options (``url``, ``query``, ...).  An
optional ``--config`` JSON file overrides ``ScreenConfig`` fields (lists as
JSON arrays).  The session comes from ``spark-submit``; nothing here sizes
executors.
"""

from __future__ import annotations

import argparse
import json
import sys

from acctscreen.config import ScreenConfig, TableNames


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="acctscreen", description=__doc__.split("\n\n")[0])
    p.add_argument("--snap-date", required=True, help="run day, yyyy-MM-dd")
    p.add_argument("--root", required=True, help="shared folder of the stage tables")
    p.add_argument("--tables", required=True, help="JSON file: input name -> table or path")
    p.add_argument("--config", help="JSON file of ScreenConfig overrides")
    p.add_argument("--stages", default="1,2,3", help="comma-separated subset of 1,2,3")
    p.add_argument("--shuffle-gb", type=float, help="size of the largest shuffle: sets what the launch configuration leaves unset")
    p.add_argument("--cores", type=int, default=1, help="cores of all executors, for --shuffle-gb")
    p.add_argument("--export-csv", action="store_true", help="also write the final table as CSV")
    return p.parse_args(argv)


def load_config(path: str | None) -> ScreenConfig:
    if not path:
        return ScreenConfig()
    with open(path, encoding="utf-8") as fh:
        raw = json.load(fh)
    fields = {k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()}
    if "registered_keys" in fields:  # pairs
        fields["registered_keys"] = tuple(tuple(p) for p in fields["registered_keys"])
    return ScreenConfig(**fields)


def main(argv: list[str] | None = None) -> dict[str, str]:
    from pyspark.sql import SparkSession

    from acctscreen.plans.pipeline import run_pipeline
    from acctscreen.plans.tuning import apply_unset, recommended_conf
    from acctscreen.sources.inputs import load_inputs

    args = parse_args(sys.argv[1:] if argv is None else argv)
    with open(args.tables, encoding="utf-8") as fh:
        names = TableNames(**json.load(fh))
    spark = SparkSession.builder.appName(f"acctscreen-{args.snap_date}").getOrCreate()
    if args.shuffle_gb:
        apply_unset(spark, recommended_conf(int(args.shuffle_gb * (1 << 30)), args.cores))
    out = run_pipeline(
        spark, load_inputs(spark, names), load_config(args.config), args.snap_date,
        root=args.root, export_csv=args.export_csv,
        stages=tuple(int(s) for s in args.stages.split(",") if s.strip()),
    )
    return {"root": out.root}


if __name__ == "__main__":
    print(json.dumps(main()))
