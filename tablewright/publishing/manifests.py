"""Image manifest documents (IIIF Presentation 3) and zoom levels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE = 256


def zoom_level(width, height, tile: int = TILE) -> Column:
    """The smallest z for which ``tile * 2^z`` covers the longer side.

    Counted in whole tiles and bits, so exact powers of two need no care.
    """
    longest = F.greatest(F.col(width), F.col(height)).cast("long")
    tiles = F.ceil(longest / F.lit(tile)).cast("long")
    return F.when(tiles <= 1, F.lit(0)).otherwise(F.length(F.bin(tiles - 1)))


def _text_list(value: Column) -> Column:
    return F.struct(F.array(value).alias("en"))


def image_manifests(
    tiles: DataFrame,
    metadata: DataFrame,
    key: str,
    base_url: str,
    title: str = "title",
    labels: Mapping[str, str] | None = None,
    unknown: str = "Unknown",
) -> DataFrame:
    """``key`` and ``manifest`` (JSON) for each image.

    ``tiles`` has the key, width and height. ``labels`` maps shown names to
    metadata columns; what is missing there shows as ``unknown``.
    """
    labels = labels or {"Artist": "artist_name", "Date": "year"}
    joined = tiles.join(metadata.select(key, title, *labels.values()), key, "left")
    name = F.col(key).cast("string")
    root = F.concat(F.lit(base_url.rstrip("/") + "/"), name)

    def url(suffix: str) -> Column:
        return F.concat(root, F.lit(suffix))

    size = [F.col("width").alias("width"), F.col("height").alias("height")]
    service = F.struct(
        root.alias("id"),
        F.lit("ImageService3").alias("type"),
        F.lit("level2").alias("profile"),
        *size,
    )
    body = F.struct(
        url("/full/max/0/default.jpg").alias("id"),
        F.lit("Image").alias("type"),
        F.lit("image/jpeg").alias("format"),
        F.array(service).alias("service"),
        *size,
    )
    annotation = F.struct(
        url("/annotation").alias("id"),
        F.lit("Annotation").alias("type"),
        F.lit("painting").alias("motivation"),
        body.alias("body"),
        url("/canvas").alias("target"),
    )
    page = F.struct(
        url("/page").alias("id"),
        F.lit("AnnotationPage").alias("type"),
        F.array(annotation).alias("items"),
    )
    canvas = F.struct(
        url("/canvas").alias("id"),
        F.lit("Canvas").alias("type"),
        *size,
        F.array(page).alias("items"),
    )
    described = F.array(
        *[
            F.struct(
                _text_list(F.lit(shown)).alias("label"),
                _text_list(F.coalesce(F.col(c).cast("string"), F.lit(unknown))).alias("value"),
            )
            for shown, c in labels.items()
        ]
    )
    manifest = F.struct(
        F.lit("http://iiif.io/api/presentation/3/context.json").alias("@context"),
        url("/manifest.json").alias("id"),
        F.lit("Manifest").alias("type"),
        _text_list(F.coalesce(F.col(title), F.concat(F.lit("Artwork "), name))).alias("label"),
        described.alias("metadata"),
        F.array(canvas).alias("items"),
    )
    return joined.select(key, F.to_json(manifest).alias("manifest"))
