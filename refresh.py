"""Run the full refresh, for example with spark-submit.

    spark-submit refresh.py --root s3a://bucket/root --snapshots s3a://bucket/raw \\
        --year 2026 --works-year 2024 \\
        --external awards=s3a://bucket/awards/{year}/awards_{year}_clean.parquet ...
"""

from __future__ import annotations

import argparse

from publicspend.plans.pipeline import EXTERNAL, Inputs, Refresh
from publicspend.session import session


def main(arguments: list[str] | None = None) -> dict[str, int]:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--root", required=True, help="folder of the layers")
    parser.add_argument("--snapshots", required=True, help="folder of the dated text files")
    parser.add_argument("--year", type=int, required=True)
    parser.add_argument("--works-year", type=int, required=True)
    parser.add_argument(
        "--external",
        action="append",
        default=[],
        metavar="TABLE=TEMPLATE",
        help=f"one for each of: {', '.join(EXTERNAL)}",
    )
    args = parser.parse_args(arguments)
    external = dict(item.split("=", 1) for item in args.external)
    spark = session("publicspend-refresh")
    refresh = Refresh(spark, args.root, args.year)
    refresh.run(Inputs.latest(spark, args.snapshots, external), args.works_year)
    for table, rows in refresh.rows.items():
        print(f"{table}: {rows:,} rows")
    return refresh.rows


if __name__ == "__main__":
    main()
