"""Command line: build, verify, publish and look at runs."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .operators import packs as P
from .operators import runs as U
from .operators import views as V


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="textmill", description=__doc__)
    top.add_argument("--root", default="artifacts/runs")
    sub = top.add_subparsers(dest="verb", required=True)
    sub.add_parser("list-packs")
    sub.add_parser("progress")
    build = sub.add_parser("build")
    build.add_argument("pack", choices=sorted(P.PACKS))
    build.add_argument("--config", default="{}", help="JSON")
    for verb in ("verify", "summarize", "publish", "view"):
        one = sub.add_parser(verb)
        one.add_argument("pack", choices=sorted(P.PACKS))
        one.add_argument("run_id")
        if verb == "publish":
            one.add_argument("to")
        if verb == "view":
            one.add_argument("--query", default="")
            one.add_argument("--page", type=int, default=1)
    compare = sub.add_parser("compare")
    compare.add_argument("left")
    compare.add_argument("right")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.verb == "list-packs":
        print("\n".join(sorted(P.PACKS)))
        return 0
    spark = SparkSession.builder.appName("textmill").getOrCreate()
    if args.verb == "build":
        print(P.run(spark, args.root, args.pack, json.loads(args.config)))
    elif args.verb == "progress":
        U.manifests(spark, args.root).select("run_id", "pack", "rows", U.status().alias("status")).orderBy("run_id").show(200, False)
    elif args.verb in ("verify", "summarize"):
        print(json.dumps(P.summarize(spark, args.root, args.pack, args.run_id), indent=2, default=str))
    elif args.verb == "publish":
        P.publish(spark, args.root, args.pack, args.run_id, args.to)
    elif args.verb == "view":
        spec = V.ViewSpec("id", ("prompt", "target"), (), ("prompt", "target"))
        rows = spark.read.parquet(f"{args.root}/{args.pack}/{args.run_id}/rows")
        V.page(V.matching(rows, spec, args.query), spec, args.page).show(200, 120)
    elif args.verb == "compare":
        runs = U.manifests(spark, args.root)
        left, right = (runs.where(runs.run_id == r).drop("run_id").withColumn("key", runs.pack) for r in (args.left, args.right))
        U.compare(left, right, "key").show(200, False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
