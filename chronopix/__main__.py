"""python -m chronopix CONFIG: plans a job over Parquet products and writes its outputs."""

from __future__ import annotations

import argparse
import json
import shlex
import sys
import time

from chronopix.functions.scalars import format_seconds
from chronopix.model import ConfigurationError
from chronopix.operators import STATISTICS


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chronopix", description="Temporal statistics over gridded observations.")
    p.add_argument("config", nargs="?", help="YAML configuration")
    p.add_argument("--products", help="JSON file: {product: {path, measurements: [{name, dtype, nodata, flags_definition}]}}")
    p.add_argument("--tile-index", nargs=2, type=int, metavar=("X", "Y"))
    p.add_argument("--tile-index-file")
    p.add_argument("--output-location")
    p.add_argument("--year", type=int)
    p.add_argument("--tides", metavar="PATH", help="Parquet table of tides for filter_product: time, height, maybe height_before and height_after")
    p.add_argument("--task-slice", help="a:b:c of the tasks, in order of tile and epoch")
    p.add_argument("--batch", type=int, metavar="N", help="print N commands that each do every Nth task")
    p.add_argument("--save-tasks", metavar="PATH")
    p.add_argument("--load-tasks", metavar="PATH")
    p.add_argument("--overwrite", action="store_true", help="replace outputs that exist; otherwise tasks that have one are skipped")
    p.add_argument("--list-statistics", action="store_true")
    p.add_argument("--version", action="version", version="chronopix 0.1")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.list_statistics:
        print("\n".join(sorted(STATISTICS)))
        return 0
    if not args.config or not args.products:
        parser().error("a configuration and --products are needed")
    if args.batch is not None:
        given = list(sys.argv[1:] if argv is None else argv)
        at = next(i for i, a in enumerate(given) if a.split("=")[0] == "--batch")
        rest = given[:at] + given[at + (1 if "=" in given[at] else 2) :]
        print("\n".join(shlex.join([sys.executable, "-m", "chronopix", *rest, "--task-slice", f"{i}::{args.batch}"]) for i in range(args.batch)))
        return 0
    from pyspark.sql import SparkSession

    from chronopix.operators.alignment import task_slice
    from chronopix.operators.calendar_filters import part_name
    from chronopix.plans import config as C
    from chronopix.plans.job import Job
    from chronopix.sinks.output import product_definition, writer
    from chronopix.sources.catalog import Catalog
    from chronopix.sources.regions import read_tiles

    started = time.monotonic()
    try:
        spark = SparkSession.builder.appName("chronopix").getOrCreate()
        with open(args.products, encoding="utf-8") as f:
            catalog = Catalog.of_files(spark, json.load(f))
        cfg = C.normalise(C.read(args.config), read_tiles(args.tile_index, args.tile_index_file), args.output_location, args.year)
        job = Job(cfg, catalog, {"tides": spark.read.parquet(args.tides)} if args.tides else {})
        tasks = spark.read.parquet(args.load_tasks) if args.load_tasks else job.tasks(spark) if args.task_slice or args.save_tasks else None
        if tasks is not None and args.task_slice:
            tasks = task_slice(tasks, args.task_slice, ["tile_x", "tile_y", "epoch_id"])
        if args.save_tasks:
            tasks.write.parquet(args.save_tasks)
            return 0
        driver = cfg["storage"].get("driver", "parquet")
        places = {f["feature_id"]: part_name(f, cfg.get("filter_product")) for f in job.features}
        out = writer(driver)(cfg.get("location") or ".", overwrite=args.overwrite, skip=not args.overwrite, places=places, chunking=cfg["storage"].get("chunking"), attributes=cfg["global_attributes"], var_attributes=cfg["var_attributes"], **{k: cfg["storage"].get(k) for k in ("tile_size", "resolution", "crs")})
        for name, df in job.run(spark).items():
            product = job.outputs[name]
            df = df.join(tasks.select("tile_x", "tile_y", "epoch_id"), ["tile_x", "tile_y", "epoch_id"], "left_semi") if tasks is not None else df
            keys = [c for c in df.columns if c not in {m.name for m in product.measurements}]
            print(out.write(df, product, keys), format_seconds(time.monotonic() - started))
            out.describe(spark, product, product_definition(product, cfg, driver))
        job.release()
        return 0
    except ConfigurationError as e:
        print(f"chronopix: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
