"""Write PLANS.md: physical plans of the headline queries over the Parquet layer.

Usage: python scripts/plans.py [sf_dir] [out.md]

The weather views of ``sf_dir`` are written once into the month-partitioned
Parquet layer (below the shared checkpoint folder); each composite query is
then planned over it and its ``explain("formatted")`` tree is kept together
with the scan lines (PartitionFilters, PushedFilters, ReadSchema).
"""

from __future__ import annotations

import contextlib
import io
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from stationspark.plans import registry  # noqa: E402
from stationspark.session import build_session, scratch_path  # noqa: E402
from stationspark.sources import fixtures, readers, sinks  # noqa: E402

KEEP = ("PartitionFilters", "PushedFilters", "ReadSchema")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> str:
    tree, _, details = text.partition("\n\n\n")
    tree = tree.replace("== Physical Plan ==\n", "")
    scans = []
    for block in details.split("\n\n"):
        lines = block.strip().splitlines()
        if lines and "Scan" in lines[0]:
            scans.append(lines[0])
            scans += [f"  {line}" for line in lines[1:] if line.startswith(KEEP)]
    return tree.rstrip() + "\n\n" + "\n".join(scans)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    out = argv[2] if len(argv) > 2 else "PLANS.md"
    spark = build_session()
    root = sinks.write_clean(fixtures.build(spark, sf_dir), scratch_path(spark, "plans-layer"))
    tables = readers.load_partitioned(spark, root)
    parts = ["# Physical plans\n",
             "Generated by `scripts/plans.py` over the clean Parquet layer "
             f"written from `{sf_dir}`. Plans are the initial adaptive plans "
             "(`isFinalPlan=false`); AQE may still coalesce partitions at run time.\n"]
    for name, build in registry.COMPOSITE.items():
        parts.append(f"## {name}\n\n```\n{summary(formatted(build(tables)))}\n```\n")
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
