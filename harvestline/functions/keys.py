"""Row keys, station ids and name classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Region country code -> station inventory country code.
STATION_COUNTRY = {"USA": "US", "IND": "IN", "BRA": "BR", "CHN": "CH", "KEN": "KE"}

# Crop name -> text found in its item names, first hit wins.
CROP_PATTERNS = {"Maize": "maize", "Wheat": "wheat", "Soybean": "soy"}

KEY_SEPARATOR = "_"


def kv_key(entity: Column, day: Column) -> Column:
    """``<entity>_<date>``."""
    return F.concat_ws(KEY_SEPARATOR, entity.cast("string"), day.cast("string"))


def key_entity(key: Column) -> Column:
    return F.split(key, KEY_SEPARATOR, 2).getItem(0)


def key_date(key: Column) -> Column:
    """Part after the first separator; NULL where there is no separator."""
    return F.get(F.split(key, KEY_SEPARATOR, 2), F.lit(1))


def station_id(usaf: Column, wban: Column) -> Column:
    return F.concat(F.trim(usaf), F.trim(wban))


def map_country(code: Column, mapping: dict[str, str] = STATION_COUNTRY) -> Column:
    """Code from a small fixed mapping, NULL where it is not listed."""
    entries = [F.lit(v) for pair in mapping.items() for v in pair]
    return F.try_element_at(F.create_map(*entries), code)


def classify_crop(item: Column, patterns: dict[str, str] = CROP_PATTERNS) -> Column:
    """Crop whose text occurs in the item name, in the order given; else NULL."""
    text = F.lower(item)
    return F.coalesce(*[F.when(text.contains(p), F.lit(c)) for c, p in patterns.items()])
