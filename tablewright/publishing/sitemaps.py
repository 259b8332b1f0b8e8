"""Sitemaps: URL tables, files of bounded size, image sitemaps and an index."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.aggregates import ordered_struct_parts
from tablewright.operators.windows import number_rows, running_total
from tablewright.session import stage

# Name spaces and limits of the sitemap protocol.
SITEMAP_NAMESPACE = "http://www.sitemaps.org/schemas/sitemap/0.9"
IMAGE_NAMESPACE = "http://www.google.com/schemas/sitemap-image/1.1"
MAX_URLS = 50_000
MAX_IMAGES_PER_URL = 1_000
MAX_BYTES = 50_000_000

SHARE = 1_000  # units that an entry takes of a file's ``max_urls * SHARE``, at least
TAGS = 3  # times the bytes of an entry's JSON that its XML has at most, by its tags and escapes


def join_url(base_url: str, path) -> Column:
    """Base and path with exactly one slash between them; no base leaves the path."""
    path = F.col(path) if isinstance(path, str) else path
    if not base_url:
        return path
    return F.concat(F.lit(base_url.rstrip("/") + "/"), F.ltrim(path, F.lit("/")))


def _constant_or_column(df: DataFrame, value) -> Column | None:
    """A name of a column stands for it; an empty value leaves the tag out."""
    if value is None or value == "":
        return None
    if isinstance(value, str) and value in df.columns:
        return F.col(value).cast("string")
    return F.lit(str(value))


def sitemap_urls(
    df: DataFrame,
    url_column: str,
    base_url: str = "",
    lastmod: str | None = None,
    changefreq: str | None = None,
    priority=None,
) -> DataFrame:
    """``loc`` and, where given, ``lastmod``, ``changefreq`` and ``priority``.

    ``changefreq`` and ``priority`` are constants or names of columns. Dates and
    timestamps become ISO dates; an empty ``lastmod`` is left out.
    """
    columns = [join_url(base_url, url_column).alias("loc")]
    if lastmod and lastmod in df.columns:
        stamp = F.col(lastmod)
        if isinstance(df.schema[lastmod].dataType, T.StringType):
            stamp = F.nullif(stamp, F.lit(""))
        else:
            stamp = F.date_format(stamp, "yyyy-MM-dd")
        columns.append(stamp.alias("lastmod"))
    for name, value in (("changefreq", changefreq), ("priority", priority)):
        column = _constant_or_column(df, value)
        if column is not None:
            columns.append(column.alias(name))
    return df.select(*columns)


def sitemap_shards(
    urls: DataFrame, max_urls: int = MAX_URLS, max_bytes: int | None = None, **kwargs
) -> DataFrame:
    """Add ``shard``: the number of the sitemap file, from 1, in the order of loc.

    No file gets more than ``max_urls`` URLs nor, with ``max_bytes``, more than
    so many bytes and one entry. The numbering is distributed.
    """
    order = ["loc", *[c for c in urls.columns if c != "loc" and _sortable(urls, c)]]
    numbered = number_rows(urls, order, "__n", unique=False, **kwargs)
    if max_bytes is None:
        shard = (F.floor((F.col("__n") - 1) / max_urls) + 1).cast("int")
        return numbered.withColumn("shard", shard).drop("__n")
    # an entry takes its share of URLs or of bytes, whichever is more, in whole units
    size = F.octet_length(F.to_json(F.struct(*urls.columns))) * TAGS
    units = F.greatest(F.lit(SHARE), F.ceil(size * F.lit(float(max_urls * SHARE) / max_bytes)))
    weighed = stage(numbered.withColumn("__units", units.cast("long")), "sitemap-entries")
    single = {k: v for k, v in kwargs.items() if k == "single_task_rows"}
    places = running_total(weighed.select("__n", "__units"), "__n", {"__sum": "__units"}, **single)
    shard = (F.floor((F.col("__sum") - F.col("__units")) / (max_urls * SHARE)) + 1).cast("int")
    return weighed.drop("__units").join(places.select("__n", shard.alias("shard")), "__n").drop("__n")


def _sortable(df: DataFrame, column: str) -> bool:
    return not isinstance(df.schema[column].dataType, (T.ArrayType, T.MapType, T.StructType))


def _write(shards: DataFrame, path: str, root: str, mode: str, *order: Column) -> None:
    # one shard is at most one file's worth of rows, so it fits a task;
    # names with a prefix are right, but the name check knows no prefixes
    (
        shards.repartition("shard")
        .sortWithinPartitions("shard", "loc", *order)
        .write.mode(mode)
        .format("xml")
        .partitionBy("shard")
        .option("rootTag", root)
        .option("rowTag", "url")
        .option("validateName", False)
        .save(path)
    )


def write_sitemaps(
    urls: DataFrame, path: str, max_urls: int = MAX_URLS, mode: str = "overwrite", **kwargs
) -> DataFrame:
    """Write ``urls`` as sitemap files, a folder ``shard=n`` for each.

    Returns the shards: number, URLs and newest ``lastmod``.
    """
    shards = sitemap_shards(urls, max_urls, **kwargs)
    _write(shards, path, f'urlset xmlns="{SITEMAP_NAMESPACE}"', mode)
    return _shard_summary(shards)


def _shard_summary(shards: DataFrame) -> DataFrame:
    newest = F.max("lastmod") if "lastmod" in shards.columns else F.lit(None).cast("string")
    return shards.groupBy("shard").agg(
        F.count(F.lit(1)).alias("urls"), newest.alias("lastmod")
    )


def image_urls(
    df: DataFrame,
    page_column: str,
    image_column: str,
    base_url: str = "",
    image_base_url: str = "",
    optional: Mapping[str, str] | None = None,
    images_per_url: int = MAX_IMAGES_PER_URL,
    **kwargs,
) -> DataFrame:
    """``loc`` and ``images``, a list of structs, for each page.

    ``optional`` maps ``title``, ``caption``, ``geo_location`` and ``license`` to
    columns. A page with more images than one entry may hold gets several
    entries, so a page with very many images never becomes one list.
    """
    fields = {"loc": join_url(image_base_url or base_url, image_column)}
    for name in ("title", "caption", "geo_location", "license"):
        if name in (optional or {}):
            fields[name] = F.col(optional[name]).cast("string")
    flat = df.select(
        join_url(base_url, page_column).alias("__page"),
        *[c.alias(n) for n, c in fields.items()],
    )
    parts = ordered_struct_parts(
        flat, "__page", list(fields), list(fields), "images", images_per_url, unique=False, **kwargs
    )
    return parts.select(F.col("__page").alias("loc"), "images")


def write_image_sitemaps(
    urls: DataFrame,
    path: str,
    max_urls: int = MAX_URLS,
    mode: str = "overwrite",
    max_bytes: int = MAX_BYTES,
    **kwargs,
) -> DataFrame:
    """Write the result of ``image_urls`` as image sitemaps; returns the shards.

    A file is bounded by its URLs and, as an entry may hold very many images, by
    its bytes.
    """
    shards = stage(sitemap_shards(urls, max_urls, max_bytes, **kwargs), "image-sitemaps")
    fields = shards.schema["images"].dataType.elementType.names
    tagged = F.transform(
        "images", lambda i: F.struct(*[i.getField(f).alias(f"image:{f}") for f in fields])
    )
    named = shards.select("loc", tagged.alias("image:image"), "shard")
    root = f'urlset xmlns="{SITEMAP_NAMESPACE}" xmlns:image="{IMAGE_NAMESPACE}"'
    _write(named, path, root, mode, F.get(F.col("image:image"), F.lit(0)))
    return shards.groupBy("shard").agg(
        F.count(F.lit(1)).alias("urls"), F.sum(F.size("images")).alias("images")
    )


def sitemap_index(shards: DataFrame, base_url: str, pattern: str = "sitemap-%05d.xml") -> DataFrame:
    """``loc`` and ``lastmod`` of each sitemap file."""
    name = F.format_string(pattern, F.col("shard"))
    lastmod = F.col("lastmod") if "lastmod" in shards.columns else F.lit(None).cast("string")
    return shards.select(join_url(base_url, name).alias("loc"), lastmod.alias("lastmod"))


def write_sitemap_index(
    index: DataFrame, path: str, mode: str = "overwrite", max_entries: int = MAX_URLS
) -> None:
    """Write the index, a folder ``index=n`` for each file of at most ``max_entries`` entries."""
    numbered = number_rows(index, ["loc", "lastmod"], "__n", unique=False)
    part = (F.floor((F.col("__n") - 1) / max_entries) + 1).cast("int")
    (
        numbered.withColumn("index", part)
        .drop("__n")
        .repartition("index")
        .sortWithinPartitions("index", "loc")
        .write.mode(mode)
        .format("xml")
        .partitionBy("index")
        .option("rootTag", f'sitemapindex xmlns="{SITEMAP_NAMESPACE}"')
        .option("rowTag", "sitemap")
        .save(path)
    )
