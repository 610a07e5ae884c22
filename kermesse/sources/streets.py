"""Address and place catalogues from map node and way tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.functions.places import in_bbox, normalise_street
from kermesse.vocab.places import BOX_CATALOGUE, PLACE_TAGS


def tagged_points(nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """tags, lat, lon of nodes and of ways (mean of their nodes)."""
    members = ways.select("id", F.explode("nodes").alias("node_id"))
    mean = (members.join(nodes.select(F.col("id").alias("node_id"), "lat", "lon"), "node_id")
            .groupBy("id").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon")))
    areas = ways.select("id", "tags").join(mean, "id").select("tags", "lat", "lon")
    return nodes.filter(F.size("tags") > 0).select("tags", "lat", "lon").unionByName(areas).filter(
        in_bbox(F.col("lat"), F.col("lon"), BOX_CATALOGUE))


def _tag(key: str) -> Column:
    return F.coalesce(F.try_element_at("tags", F.lit(key)), F.lit(""))


def address_catalogue(points: DataFrame) -> DataFrame:
    """Street, leading 1-5 digits of the house number, city."""
    number = F.regexp_extract(_tag("addr:housenumber"), r"^\d{1,5}", 0).try_cast("int")
    return points.filter((_tag("addr:street") != "") & number.isNotNull()).select(
        normalise_street(_tag("addr:street")).alias("calle"), number.alias("numero"),
        normalise_street(_tag("addr:city")).alias("ciudad"), "lat", "lon")


def place_catalogue(points: DataFrame) -> DataFrame:
    """Named points whose tag is in the list; the first tag key wins."""
    kind = F.coalesce(*[F.when(_tag(k).isin(*vals), _tag(k)) for k, vals in PLACE_TAGS.items()])
    street = _tag("addr:street")
    address = F.when(street != "", F.trim(F.concat_ws(" ", street, _tag("addr:housenumber")))).otherwise("")
    return points.filter((_tag("name") != "") & kind.isNotNull()).select(
        normalise_street(_tag("name")).alias("nombre"), kind.alias("tipo"), "lat", "lon", address.alias("direccion"),
        _tag("addr:city").alias("ciudad"))

