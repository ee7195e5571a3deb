"""Command line of the metric registry: list, status, run and rebuild.

    python -m panelloom.cli --registry package.module:build --grid grid.parquet --store products status

``build(spark)`` returns a registry; the grid is a table with (day, code) and the inputs of the metrics.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import registry as plans


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="panelloom")
    p.add_argument("--registry", required=True, help="module:function that takes a session and returns a registry")
    p.add_argument("--grid", required=True, help="Parquet table of the dense panel")
    p.add_argument("--store", required=True, help="folder of the products")
    p.add_argument("--start", help="first day of the grid to use")
    p.add_argument("--end", help="last day of the grid to use")
    p.add_argument("--least", type=int, default=100, help="names that a cross-section needs")
    p.add_argument("--dry-run", action="store_true", help="only tell what would be computed")
    p.add_argument("command", choices=["list", "status", "run", "rebuild"])
    p.add_argument("names", nargs="*", help="metrics; all where none is named")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Returns 0, or 1 where a metric failed or was blocked."""
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("panelloom").getOrCreate()
    module, _, function = args.registry.partition(":")
    reg = getattr(importlib.import_module(module), function)(spark)
    names = args.names or list(reg.metrics)
    order = reg.order(names)
    if args.command == "list":
        for m in order:
            print(m.name, "market" if m.market else "label" if m.label else "metric", ",".join(m.parents) or "-", sep="\t")
        return 0
    if args.command == "status":
        for m in order:
            have = plans.stored(spark, args.store, m.name)
            last = None if have is None else have.agg(F.count(F.lit(1)).alias("n"), F.max("day").alias("day")).first()
            print(m.name, "missing" if last is None else f"{last['n']} rows until {last['day']}", sep="\t")
        return 0
    if args.dry_run:
        for m in order:
            kept = args.command == "run" and plans.stored(spark, args.store, m.name) is not None
            print(m.name, "keep" if kept else "compute", sep="\t")
        return 0
    grid = spark.read.parquet(args.grid)
    if args.start:
        grid = grid.where(F.col("day") >= F.lit(args.start).cast("date"))
    if args.end:
        grid = grid.where(F.col("day") <= F.lit(args.end).cast("date"))
    state = plans.execute(reg, names, grid, args.store, least=args.least, resume=args.command == "run")
    for row in state:
        print(*row, sep="\t")
    return int(any(s in ("failed", "blocked") for _, s, _ in state))


if __name__ == "__main__":
    sys.exit(main())
