"""Whole jobs through the command line, on stand-in sources, read back from what they leave."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import jobs
from ..plans.training import CHANNEL_MEAN, CHANNEL_STD
from ..session import scratch_dir
from ..sources.readers import scan
from ..sources.sinks import overwrite
from . import scalars, standins  # noqa: F401  (scalars registers the SQL that publish_run shares)
from .registry import ORACLES, query, table
from .streams import write_files


def command(spark, *words: str) -> None:
    jobs.run(spark, jobs.parser().parse_args(list(words)))


@query("publish_run", ORACLES["topic_encode_json"])
def publish_run(spark, sf):
    """The publish job from a table of readings to a topic folder; a second one whose source is not there sends nothing."""
    root = scratch_dir(spark, "published")
    overwrite(standins.frame(spark, sf, "telematics"), f"{root}/readings")
    command(spark, "publish", "--base", root, "--source", f"{root}/readings", "--folder", f"{root}/topic")
    try:
        command(spark, "publish", "--base", root, "--source", f"{root}/missing", "--folder", f"{root}/topic")
        raise AssertionError("a job without its source ended well")
    except SystemExit:
        return scan(spark, f"{root}/topic")


def grey_files(rows: DataFrame) -> DataFrame:
    """(name, content): 8 x 8 grey PNG files of (name, pixels, broken), the broken ones cut short."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head = chunk(b"IHDR", struct.pack(">IIBBBBB", 8, 8, 8, 0, 0, 0, 0))
        for part in parts:
            files = []
            for name, pixels, broken in part.itertuples(index=False):
                raster = zlib.compress(b"".join(b"\0" + bytes(pixels[i:i + 8]) for i in range(0, 64, 8)))
                data = b"\x89PNG\r\n\x1a\n" + head + chunk(b"IDAT", raster) + chunk(b"IEND", b"")
                files.append((name, data[:20] if broken else data))
            yield pd.DataFrame(files, columns=["name", "content"])

    return rows.select("name", "pixels", "broken").mapInPandas(run, "name string, content binary")


LEVEL = "greatest(0, least(255, floor(cast(x as double) * 255 + 128)))"


@query("train_run", f"""
    select 'class' || chr(97 + label) as label, count(*) filter (vec_id % 50 <> 0) as features, count(*) filter (vec_id % 50 = 0) as undecoded,
      ceil(0.2 * count(*) filter (vec_id % 50 <> 0))::bigint as held_out, 2 as epochs,
      round(avg(case when vec_id % 50 <> 0 then
        (list_avg(list_transform(embedding, lambda x: {LEVEL})) / 255 - {CHANNEL_MEAN[0]}) / {CHANNEL_STD[0]} end), 4) as mean_red
    from embeddings group by label""")
def train_run(spark, sf):
    """The training job on a folder of image files, some of them broken: what it records of features, labels and epochs."""
    root = scratch_dir(spark, "trained")
    level = "cast(greatest(0, least(255, floor(x * 255 + 128))) as int)"
    rows = table(spark, sf, "embeddings").selectExpr(
        "concat(vec_id, '-class', chr(97 + label), '.png') as name", "vec_id % 50 = 0 as broken",
        f"unhex(array_join(transform(embedding, x -> lpad(hex({level}), 2, '0')), '')) as pixels")
    write_files(grey_files(rows), f"{root}/images")
    command(spark, "train", "--base", root, "--images", f"{root}/images", "--run_id", "one", "--epochs", "2",
            "--batch_size", "1000000", "--img_size", "4")
    run = f"{root}/runs/damage"
    label = F.regexp_extract("path", "-(class[a-z]+)", 1)
    undecoded = scan(spark, f"{run}/undecoded/one").groupBy(label.alias("label")).agg(F.count("*").alias("undecoded"))
    red = F.aggregate(F.filter("features", lambda f, i: i % 3 == 0), F.lit(0.0), lambda a, f: a + f.cast("double")) / 16
    features = scan(spark, f"{run}/features/one").groupBy("label").agg(F.count("*").alias("features"), F.avg(red).alias("mean_red"))
    names = scan(spark, f"{run}/labels").select("label_id", "label")
    tested = scan(spark, f"{run}/confusion").where("epoch = 2").groupBy("label_id").agg(F.sum("n").alias("held_out")).join(names, "label_id")
    epochs = scan(spark, f"{run}/metrics").where("val_accuracy between 0 and 100").agg(F.count("*").cast("int").alias("epochs"))
    rows = features.join(undecoded, "label", "left").fillna(0, ["undecoded"]).join(tested, "label").join(epochs)  # the last is one row
    return rows.select("label", "features", "undecoded", "held_out", "epochs", F.round("mean_red", 4).alias("mean_red"))
