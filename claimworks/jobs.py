"""Command line for the jobs: ``python -m claimworks.jobs <job> [options]``.

Under spark-submit the same arguments follow the script name.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from .functions.geo import geocode_from_table, geocode_nearest
from .operators.checks import check_declared
from .plans import gold, load, publish, training
from .schemas import CAPTURED, DECLARED, REFERENCES
from .session import build_session
from .sources.readers import scan
from .sources.sinks import EVERY_MINUTE
from .streaming import ingest, refine
from .streaming.follow import References
from .streaming.star import StarJoin
from .streaming.tables import BUCKETS, open_table


def topic_source(args: argparse.Namespace) -> dict:
    if args.folder:
        return {"folder": args.folder}
    source = {"servers": args.servers}
    return {**source, "pattern": args.pattern} if args.pattern else {**source, "topic": args.topic}


def wait(spark: SparkSession, streams: list, once: bool) -> None:
    if not once:
        spark.streams.awaitAnyTermination()
    for stream in streams:
        stream.awaitTermination()


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    trigger = None if getattr(args, "once", False) else EVERY_MINUTE
    bronze, silver = f"{args.base}/bronze", f"{args.base}/silver"
    checkpoints = f"{args.base}/_checkpoints"
    if args.job == "ingest-changes":
        streams = [ingest.ingest_changes(spark, topic_source(args), bronze, f"{checkpoints}/changes", args.format, trigger,
                                         buckets=args.buckets, quarantine=f"{bronze}/refused" if args.quarantine else None)]
        wait(spark, streams, args.once)
    elif args.job == "ingest-telematics":
        streams = [ingest.ingest_telematics(spark, topic_source(args), bronze,
                                            f"{checkpoints}/telematics", args.format, trigger)]
        wait(spark, streams, args.once)
    elif args.job == "ingest-objects":
        streams = ingest.ingest_objects(spark, args.landing or f"{args.base}/landing", bronze,
                                        f"{checkpoints}/objects", args.format, trigger)
        wait(spark, streams, args.once)
    elif args.job == "silver":
        streams = refine.start_silver(spark, bronze, silver, f"{checkpoints}/silver", args.format,
                                      trigger, propagate_deletes=args.propagate_deletes, copies_within=args.copies_within)
        wait(spark, streams, args.once)
    elif args.job == "gold":
        locate = None
        if args.places:
            def locate(df):
                places = scan(spark, args.places, args.format)
                if args.edits:
                    return geocode_nearest(df, "address", places, args.edits)
                return geocode_from_table(df, "address", places)
        core = None
        if args.keep_join:
            sides = (open_table(spark, f"{silver}/{n}", gold.SILVER_KEYS[n], args.format) for n in ("claim", "policy", "customer"))
            star = StarJoin(*sides, f"{silver}/star")
            star.follow()
            core = star.table.read()
        gold.build_gold(spark, silver, f"{args.base}/gold", args.format, locate, core)
    elif args.job == "compact":
        for name, keys in [(n, k) for n, (_, k) in CAPTURED.items()]:
            open_table(spark, f"{bronze}/{name}", keys, args.format).compact()
        for table in refine.SILVER_TABLES:
            refine.open_silver(spark, table, silver, args.format).compact()
            sums = refine.sums_of(spark, table, silver, args.format)
            if sums is not None:
                sums.follow()
                sums.compact()
    elif args.job == "check":
        for name, declared in DECLARED.items():
            rows = open_table(spark, f"{bronze}/{name}", [declared.key], args.format).read()
            if rows is not None:
                check_declared(rows, declared).where("violations > 0").show(truncate=False)
        if args.format != "delta":
            for child, column, parent in REFERENCES:
                sides = [open_table(spark, f"{bronze}/{n}", [DECLARED[n].key]) for n in (child, parent)]
                kept = References(sides[0], column, sides[1], f"{bronze}/references/{child}.{column}")
                kept.follow()
                if kept.check() is not None:
                    kept.check().where("violations > 0").show(truncate=False)
    elif args.job == "load":
        load.load_extracts(
            spark, {"customer": args.customers, "policy": args.policies, "claim": args.claims},
            f"{args.base}/database", f"{args.base}/_staging/{int(time.time())}", args.format)
    elif args.job == "publish":
        target = {"folder": args.folder} if args.folder else {"servers": args.servers, "topic": args.topic}
        sent = publish.publish_telematics(spark, args.source, **target)
        if sent is None:
            raise SystemExit(f"{args.source} is not readable")
        print(f"sent {sent} messages")
    elif args.job == "train":
        if args.images:
            images = training.folder_images(spark, args.images)
        else:
            images = training.table_images(
                open_table(spark, f"{silver}/training_images", ["path"], args.format).read(),
                f"{args.landing or f'{args.base}/landing'}/training_imgs")
        params = training.Params(epochs=args.epochs, lr=args.lr, batch_size=args.batch_size, seed=args.seed,
                                 img_size=args.img_size, reg=args.reg)
        done = training.train_images(
            images, f"{args.base}/runs/{args.experiment_name}", args.run_id, params)
        done.metrics.orderBy("epoch").show()


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="claimworks.jobs", description=__doc__)
    jobs = root.add_subparsers(dest="job", required=True)

    def job(name: str, stream: bool = False, topic: str | None = None) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.add_argument("--base", required=True, help="root of the bronze, silver and gold tables")
        sub.add_argument("--format", default="parquet", choices=["parquet", "delta"])
        if stream:
            sub.add_argument("--once", action="store_true", help="take what is there, then stop")
        if topic is not None:
            sub.add_argument("--servers", help="broker addresses")
            sub.add_argument("--topic", default=topic)
            sub.add_argument("--pattern")
            sub.add_argument("--folder", help="parquet message folder instead of a broker")
        return sub

    changes = job("ingest-changes", stream=True, topic="")
    changes.add_argument("--buckets", type=int, default=BUCKETS, help="of new tables: so many that one fits a task")
    changes.add_argument("--quarantine", action="store_true", help="keep messages that cannot be applied")
    job("ingest-telematics", stream=True, topic="telematics_topic")
    job("ingest-objects", stream=True).add_argument("--landing")
    refined = job("silver", stream=True)
    refined.add_argument("--propagate-deletes", action="store_true")
    refined.add_argument("--copies-within", help="leave out readings that come again within this time, e.g. '10 minutes'")
    golden = job("gold")
    golden.add_argument("--places", help="table of (address, latitude, longitude)")
    golden.add_argument("--edits", type=int, default=0, help="edits by which an address may differ from the table's")
    golden.add_argument("--keep-join", action="store_true", help="keep the claim join up by silver's changes (folder tables)")
    job("compact")
    job("check")
    extracts = job("load")
    for name in ("customers", "policies", "claims"):
        extracts.add_argument(f"--{name}", required=True, help="headed CSV")
    job("publish", topic="telematics_topic").add_argument("--source", required=True)
    train = job("train")
    train.add_argument("--images", help="folder of images instead of the silver table")
    train.add_argument("--landing", help="where the silver table's images lie")
    train.add_argument("--experiment_name", default="damage")
    train.add_argument("--run_id", default=time.strftime("%Y%m%d-%H%M%S"))
    train.add_argument("--epochs", type=int, default=5)
    train.add_argument("--lr", type=float, default=0.001)
    train.add_argument("--batch_size", type=int, default=32)
    train.add_argument("--reg", type=float, default=0.0)
    train.add_argument("--img_size", type=int, default=224)
    train.add_argument("--seed", type=int, default=42)
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    run(build_session(f"claimworks-{args.job}"), args)


if __name__ == "__main__":
    main()
