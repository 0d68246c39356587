"""Geocoding by gazetteer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stallkeeper.functions.fields import location_name
from stallkeeper.operators.lookup import lookup
from stallkeeper.plans.stages import Stage


def resolve_locations(
    locations: DataFrame, gazetteer: DataFrame, stage: Stage | None = None
) -> DataFrame:
    """``location`` to place, for distinct locations: the first comma part that resolves wins."""
    parts = locations.select(
        "location", F.posexplode(F.split("location", ", ")).alias("pos", "part")
    )
    places = gazetteer.select(
        F.col("name").alias("part"), F.struct("name", "lat", "lon", "country").alias("place")
    )
    hits = lookup(parts, places, "part", ["location", "pos"], stage=stage, name="places").filter(F.col("place").isNotNull())
    best = hits.groupBy("location").agg(F.min(F.struct("pos", "place")).alias("best"))
    return best.select(
        "location",
        F.col("best.place.name").alias("loc_name"),
        F.col("best.place.lat").alias("lat"),
        F.col("best.place.lon").alias("lon"),
        F.col("best.place.country").alias("country"),
    )


def geocode(
    rows: DataFrame, gazetteer: DataFrame, row_key: list[str], stage: Stage | None = None
) -> DataFrame:
    """Add ``loc_name, lat, lon, country``. Only the distinct locations meet the gazetteer."""
    named = rows.withColumn("location", location_name(F.col("location")))
    distinct = named.select("location").filter(F.col("location") != "").distinct()
    resolved = resolve_locations(distinct, gazetteer, stage)
    return lookup(named, resolved, "location", row_key, stage=stage, name="locations")


def top_places(places: DataFrame, stage: Stage, key: str = "place_id", parent: str = "parent_id") -> DataFrame:
    """``key, top, levels``: the place at the end of each place's line of parents, and how far up it is.

    A place without a parent, or whose parent is not in the table, is its own top. Places on or below a
    cycle have neither. Keys are distinct. Each round doubles the length of the lines that are known, so a
    tree of depth d takes about log2(d) rounds; places whose line is complete are not joined again.
    """
    known = places.select(F.col(f"`{key}`").alias("at"), F.col(f"`{parent}`").alias("up"))
    known = known.filter("at IS NOT NULL")
    there = known.select(F.col("at").alias("up"), F.lit(True).alias("there"))
    lines = known.join(there, "up", "left").select(
        "at",
        F.when(F.col("there"), F.col("up")).otherwise(F.col("at")).alias("up"),
        F.when(F.col("there"), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("levels"),
        F.coalesce("there", F.lit(False)).alias("open"),
    )
    lines = stage(lines, "lines_0")
    number, reach, most = 0, 1, lines.count()
    # A line longer than there are places goes in a circle.
    while reach <= most and not lines.filter("open").isEmpty():
        number, reach = number + 1, 2 * reach
        further = lines.select(
            F.col("at").alias("up"),
            F.col("up").alias("above"),
            F.col("levels").alias("more"),
            F.col("open").alias("goes_on"),
        )
        moved = lines.filter("open").join(further, "up").select(
            "at", F.col("above").alias("up"), (F.col("levels") + F.col("more")).alias("levels"),
            F.col("goes_on").alias("open"),
        )
        lines = stage(lines.filter("NOT open").unionByName(moved), f"lines_{number}")
    done = ~F.col("open")
    return lines.select(
        F.col("at").alias(key),
        F.when(done, F.col("up")).alias("top"),
        F.when(done, F.col("levels")).alias("levels"),
    )
