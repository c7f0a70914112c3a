"""python -m millrace COMMAND: the curation steps over paths, and any registered query."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .session import session
from .sources import archives, delimited, specs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("inventory", help="pair image and label archives: paired, unmatched, summary")
    p.add_argument("images")
    p.add_argument("labels")
    p.add_argument("out")
    p.add_argument("--image-prefix", default="TS")
    p.add_argument("--label-prefix", default="TL")
    p.add_argument("--kind", default="단일")
    p = sub.add_parser("splits", help="split a canonical manifest (Parquet) and plan its sampler")
    p.add_argument("manifest")
    p.add_argument("out")
    p.add_argument("--ratio", type=float, default=0.10)
    p.add_argument("--least", type=int, default=24)
    p.add_argument("--most", type=int, default=128)
    p = sub.add_parser("validate", help="report on a canonical manifest (Parquet)")
    p.add_argument("manifest")
    p.add_argument("out")
    p = sub.add_parser("check-shards", help="samples of tar shards without image or label")
    p.add_argument("shards")
    p.add_argument("out")
    p = sub.add_parser("sources", help="the declared sources below a root")
    p.add_argument("root")
    p.add_argument("out")
    p.add_argument("--include", choices=["all", "train", "validation"], default="all")
    p = sub.add_parser("coco-report", help="strict report on a COCO file against a class list (CSV)")
    p.add_argument("coco")
    p.add_argument("classes")
    p.add_argument("out")
    p.add_argument("--floor", type=int, default=0)
    p = sub.add_parser("generate", help="lay out a synthetic set: images, annotations, failed combinations")
    p.add_argument("sizes", help="Parquet with combo, size")
    p.add_argument("classes", help="Parquet with product_id, category_id, class_index")
    p.add_argument("bank", help="Parquet with asset_id, product_id, aspect")
    p.add_argument("profile", help="JSON with bbox_side_px_pct")
    p.add_argument("out")
    p.add_argument("--width", type=int, default=976)
    p.add_argument("--height", type=int, default=1280)
    p.add_argument("--seed", default="0")
    p = sub.add_parser("query", help="run a registered query over tables and write its result")
    p.add_argument("name")
    p.add_argument("tables")
    p.add_argument("out")
    return top


def main(arguments: list[str] | None = None) -> None:
    from . import catalog
    from .operators import reports
    from .plans import generation, workflow

    args, spark = parser().parse_args(arguments), session()
    if args.command == "inventory":
        rows, unmatched, summary = workflow.inventory(spark, args.images, args.labels, args.image_prefix, args.label_prefix, args.kind)
        for name, df in (("paired", rows), ("unmatched", unmatched), ("summary", summary)):
            delimited.write_table(df, f"{args.out}/{name}")
    elif args.command == "splits":
        whole, plan = workflow.split_manifest(spark.read.parquet(args.manifest), ratio=args.ratio, least=args.least, most=args.most)
        delimited.write_table(whole, f"{args.out}/split_manifest")
        delimited.write_table(plan, f"{args.out}/sampler_plan")
    elif args.command == "validate":
        workflow.validate_manifest(spark.read.parquet(args.manifest)).write.mode("overwrite").json(args.out)
    elif args.command == "check-shards":
        workflow.shard_issues(archives.tar_members(spark, args.shards)).write.mode("overwrite").json(args.out)
    elif args.command == "sources":
        specs.as_table(spark, specs.selected(specs.declared(args.root), args.include)).write.mode("overwrite").json(args.out)
    elif args.command == "coco-report":
        images, annotations, _ = delimited.coco(spark, args.coco)
        named = spark.read.option("header", True).option("inferSchema", True).csv(args.classes)
        boxed = annotations.select("image_id", F.col("id").alias("pos"), "product_id", "category_id", "class_index", *[F.get("bbox", F.lit(i)).alias(c) for i, c in enumerate("xywh")])
        report = reports.strict_report(images.withColumnRenamed("id", "image_id"), boxed, named, floor=args.floor)
        specs.write_report(spark, specs.report_document(report), args.out)
    elif args.command == "generate":
        sides = specs.domain_profile(spark, args.profile)["bbox_side_px_pct"]
        points = sorted((float(k), float(v)) for k, v in sides.items())
        tables = [spark.read.parquet(p) for p in (args.sizes, args.classes, args.bank)]
        made = generation.generate(*tables, points, args.width, args.height, args.seed)
        for name, df in zip(("images", "annotations", "failed"), made, strict=True):
            delimited.write_table(df, f"{args.out}/{name}")
    else:
        catalog.queries()[args.name](spark, args.tables).write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
