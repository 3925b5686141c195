"""Outline the physical plan of every stage table ``run_pipeline`` writes:
shuffles, joins (with the strategy Spark chose), aggregates, windows,
sorts and scans with their pushed filters.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import acctscreen.plans.pipeline as P  # noqa: E402
from acctscreen.sources import fixtures  # noqa: E402

KEEP = re.compile(r"Exchange|Join|Aggregate|Window|Sort |Scan parquet|Subquery|Union|Expand|Filter|Generate")


def outline(df) -> list[str]:
    qe = df._jdf.queryExecution()
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(qe, "simple")
    out: list[str] = []
    seen: set[str] = set()
    skip_below = None  # indentation of a repeated subquery being skipped
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :|+-"))
        if skip_below is not None:
            if indent > skip_below:
                continue
            skip_below = None
        if "Subquery subquery" in line:
            key = re.sub(r"#\d+L?|\[id=#\d+\]", "", line.strip(" :|+-"))
            if key in seen:
                out.append(line[: indent] + "(same scalar subquery, reused)")
                skip_below = indent
                continue
            seen.add(key)
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", line)
        line = re.sub(r"file:[^ ,\]]*", "<path>", line)
        out.append(line[:230])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    report: list[tuple[str, list[str]]] = []
    orig = P.write_day

    def traced(df, path, snap):
        report.append((path.rsplit("/", 1)[1], outline(df)))
        return orig(df, path, snap)

    P.write_day = traced
    import tempfile

    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="acctscreen-plans-"))
    P.run_pipeline(spark, fixtures.load(spark, sf_dir), fixtures.TEST_CONFIG, fixtures.SNAP_DATE)
    for name, lines in report:
        print(f"### {name}\n\n```")
        print("\n".join(lines))
        print("```\n")


if __name__ == "__main__":
    main()
