"""Crop statistics and region names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestline.functions.keys import CROP_PATTERNS, classify_crop
from harvestline.functions.numeric import hg_ha_to_t_ha, md5_fraction, stable_round
from harvestline.operators.keyed import first_per_key

# Fixed values of the crop statistics.
FAO_AREAS = ("United States of America", "United States")
FAO_AREA_TEXT = "China"
FAO_ELEMENTS = ("yield", "area harvested", "production")

VARIATION_LOW = 0.85
VARIATION_WIDTH = 0.30
AREA_LOW_HA = 5000
AREA_STEPS = 45001


def filter_fao(
    df: DataFrame,
    years: Sequence[int],
    areas: Sequence[str] = FAO_AREAS,
    area_text: str = FAO_AREA_TEXT,
    items: Sequence[str] = tuple(CROP_PATTERNS.values()),
    elements: Sequence[str] = FAO_ELEMENTS,
) -> DataFrame:
    """Rows of the wanted areas, crops, years and measures."""
    return df.filter(
        (F.col("Area").isin(*areas) | F.col("Area").contains(area_text))
        & F.lower("Item").rlike("|".join(items))
        & F.col("Year").isin(*years)
        & F.lower("Element").rlike("|".join(elements))
    )


def yields_only(df: DataFrame) -> DataFrame:
    return df.filter(F.lower("Element").contains("yield"))


def spread_yields(national: DataFrame, regions: DataFrame) -> DataFrame:
    """National yields handed down to the regions of the country.

    Each (region, crop, year) varies by up to 15% around the national value and
    gets an area in hectares, both drawn repeatably from its key.
    """
    key = [F.col("county_id"), F.col("crop"), F.col("year")]
    factor = F.lit(VARIATION_LOW) + F.lit(VARIATION_WIDTH) * md5_fraction(*key)
    area = F.floor(md5_fraction(F.lit("area"), *key) * AREA_STEPS) + AREA_LOW_HA
    return national.join(regions.select("county_id", "country"), "country").select(
        "county_id",
        "crop",
        "year",
        stable_round(F.col("yield_mt_ha") * factor, 4).alias("yield_mt_ha"),
        area.cast("int").alias("area_ha"),
    )


def national_yields(fao: DataFrame, patterns: dict[str, str] = CROP_PATTERNS) -> DataFrame:
    """Yield rows by area, crop and year in tonnes per hectare; item kept for order."""
    return (
        yields_only(fao)
        .select(
            F.col("Area").alias("area"),
            F.col("Item").alias("item"),
            classify_crop(F.col("Item"), patterns).alias("crop"),
            F.col("Year").alias("year"),
            hg_ha_to_t_ha(F.col("Value")).alias("yield_mt_ha"),
        )
        .dropna(subset=["crop", "year", "yield_mt_ha"])
    )


def match_region(regions: DataFrame, names: DataFrame) -> DataFrame:
    """Boundary of every region by name within its country, in three steps.

    ``regions``: county_id, country, name. ``names``: country, name, ord (order of
    the rows). Names are only looked for in the same country.
    Upper and lower case are equal. An equal name wins, then the first name that
    contains the region's, then the first that contains its first word.

    Containment is an equality join on the substrings of a name, not a loop over
    pairs; only substrings as long as some wanted text are made, and once for a
    name however often it occurs. Each wanted text keeps its first name only,
    before regions meet it. Names are place names of at most 100 characters.
    """
    wanted = regions.select(
        "county_id",
        "country",
        F.col("name").alias("region"),
        F.posexplode(
            F.array(
                F.struct(F.lit(True).alias("whole"), F.lower("name").alias("text")),
                F.struct(F.lit(False).alias("whole"), F.lower("name").alias("text")),
                F.struct(
                    F.lit(False).alias("whole"),
                    F.split(F.trim(F.lower("name")), r"\s+").getItem(0).alias("text"),
                ),
            )
        ).alias("tier", "probe"),
    ).select("county_id", "country", "region", (F.col("tier") + 1).alias("tier"), "probe.*")

    asked = ["country", "whole", "text"]
    texts = wanted.select(*asked).distinct()
    sizes = texts.filter(~F.col("whole")).agg(F.collect_set(F.length("text"))).scalar()
    text = F.lower("name")
    length = F.length(text)
    pieces = F.flatten(
        F.transform(
            F.sequence(F.lit(1), length),
            lambda start: F.transform(
                F.filter("sizes", lambda size: size <= length - start + 1),
                lambda size: F.substring(text, start, size),
            ),
        )
    )
    once = first_per_key(
        names.withColumn("lowered", text).filter(length > 0),
        ["country", "lowered"],
        ["ord", "name"],
    )
    named = once.drop("lowered").withColumn("sizes", sizes)
    offered = named.select(
        "country", "name", "ord", F.lit(True).alias("whole"), text.alias("text")
    ).unionByName(
        named.select(
            "country",
            "name",
            "ord",
            F.lit(False).alias("whole"),
            F.explode(F.array_distinct(pieces)).alias("text"),
        )
    )
    first = first_per_key(
        offered.join(texts, asked, "left_semi"), asked, ["ord", "name"]
    )
    hits = wanted.join(first, asked)
    return first_per_key(hits, ["county_id"], ["tier"]).select(
        "county_id", "country", "region", "tier", F.col("name").alias("matched"), "ord"
    )
