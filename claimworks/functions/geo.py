"""Coordinates for addresses."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.fuzzy import near_texts
from ..operators.joins import lookup_join
from .casts import ColumnOrName, as_column

LAT_LONG = "latitude float, longitude float"


def _unit(digest: Column, start: int) -> Column:
    """Eight hex digits of a digest as a number in [0, 1]."""
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def hashed_lat_long(address: ColumnOrName) -> Column:
    """Repeatable stand-in coordinates, computed in the JVM from the text's digest."""
    digest = F.md5(as_column(address).cast("binary"))
    latitude = (_unit(digest, 1) * 180 - 90).cast("float")
    longitude = (_unit(digest, 9) * 360 - 180).cast("float")
    known = as_column(address).isNotNull()
    return F.struct(
        F.when(known, latitude).alias("latitude"), F.when(known, longitude).alias("longitude")
    )


def hash_geocoder() -> Callable[[pd.Series], pd.DataFrame]:
    """The same coordinates as a batch geocoder, to exercise the UDF path."""
    import hashlib

    def locate(addresses: pd.Series) -> pd.DataFrame:
        known = addresses.notna().to_numpy()
        digests = [hashlib.md5(a.encode()).digest()[:8] for a in addresses[known]]
        words = np.frombuffer(b"".join(digests), dtype=">u4").reshape(-1, 2)
        units = words.astype("float64") / 4294967295.0
        out = np.full((len(addresses), 2), np.nan)
        out[known] = units * [180, 360] - [90, 180]
        return pd.DataFrame(out, columns=["latitude", "longitude"]).astype("float32")

    return locate


def geocode_udf(make_geocoder: Callable[[], Callable[[pd.Series], pd.DataFrame]]):
    """Iterator pandas UDF: the client is made once per task, then fed batches.

    A batch that fails is looked up again address by address, so that only the
    addresses at fault end with null coordinates.
    """

    def attempt(geocoder, addresses: pd.Series) -> pd.DataFrame:
        try:
            return geocoder(addresses)
        except Exception:  # a failed lookup must not fail the job
            if len(addresses) > 1:
                parts = [attempt(geocoder, addresses.iloc[[i]]) for i in range(len(addresses))]
                return pd.concat(parts, ignore_index=True)
            return pd.DataFrame({"latitude": [np.nan], "longitude": [np.nan]})

    @F.pandas_udf(LAT_LONG)
    def locate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        geocoder = make_geocoder()
        for addresses in batches:
            found = attempt(geocoder, addresses)
            yield found.astype(object).where(found.notna(), None)

    return locate


def _no_place() -> Column:
    nothing = F.lit(None).cast("float")
    return F.struct(nothing.alias("latitude"), nothing.alias("longitude"))


def geocode(df: DataFrame, address: str, locate, out: str = "lat_long") -> DataFrame:
    """Add coordinates, looking every distinct address up once.

    The distinct step combines map-side, so an address shared by a third of the
    rows costs one look-up; the join back is plain, for AQE to broadcast or
    split. A row without an address gets null coordinates.
    """
    known = df.select(address).filter(F.col(address).isNotNull()).distinct()
    places = known.withColumn(out, locate(F.col(address)))
    return lookup_join(df, places, [address], "left").withColumn(out, F.coalesce(out, _no_place()))


def geocode_from_table(
    df: DataFrame, address: str, places: DataFrame, out: str = "lat_long"
) -> DataFrame:
    """Coordinates from a (address, latitude, longitude) table; unknown gives nulls."""
    place = F.struct(
        F.col("latitude").cast("float").alias("latitude"),
        F.col("longitude").cast("float").alias("longitude"),
    )
    known = places.groupBy(F.col("address").alias(address)).agg(F.min(place).alias(out))
    return lookup_join(df, known, [address], "left").withColumn(out, F.coalesce(out, _no_place()))


def geocode_nearest(
    df: DataFrame, address: str, places: DataFrame, edits: int = 2, out: str = "lat_long"
) -> DataFrame:
    """Coordinates of the nearest address of a (address, latitude, longitude) table within ``edits`` edits.

    Of equally near addresses the first in order counts, of several places of one
    address the least. Distinct addresses are compared, not rows. Rows without an
    address, and those with nothing near, get null coordinates. What a smaller
    distance finds is not looked for at a larger one, where a text has more neighbours.
    """
    rest = df.select(F.col(address).alias("a")).where(F.col("a").isNotNull()).distinct()
    nearest = []
    for within in range(edits + 1):
        near = near_texts(rest, places.select("address"), within)
        nearest.append(near.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("_best")))
        rest = rest.join(nearest[-1].select("a"), "a", "left_anti")
    best = reduce(DataFrame.unionByName, nearest).select(F.col("a").alias(address), F.col("_best.b").alias("_place"))
    found = geocode_from_table(best, "_place", places, out).drop("_place")
    return lookup_join(df, found, [address], "left").withColumn(out, F.coalesce(out, _no_place()))
