"""Enriched sales: each sale with its artwork, its artist and price metrics.

Inputs have the raw columns

* sales: sale_id, artwork_id, sale_date, sale_price_usd, buyer_country
* artworks: artwork_id, title, artist_id, year, medium, price_usd
* artists: artist_id, name, nationality
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import normalise_name, percent_change, price_difference
from tablewright.operators.filters import HIGH_VALUE_MINIMUM, filter_number
from tablewright.operators.joins import broadcast_if_small
from tablewright.operators.ordering import sort_rows
from tablewright.quality.schema import Field, TableSchema
from tablewright.sources.colocated import write_bucketed

# Columns, types and rules of the enriched sales.
SALES_SCHEMA = TableSchema(
    "sales_transform",
    {
        "sale_id": Field("bigint"),
        "artwork_id": Field("bigint"),
        "sale_date": Field("string"),
        "sale_price_usd": Field("bigint", gt=0),
        "buyer_country": Field("string"),
        "title": Field("string"),
        "artist_id": Field("bigint"),
        "artwork_year": Field("double", nullable=True),
        "medium": Field("string"),
        "list_price_usd": Field("bigint", gt=0),
        "artist_name": Field("string"),
        "nationality": Field("string"),
        "price_diff": Field("bigint"),
        "pct_change": Field("double", nullable=True),
    },
)


# From this many sales on it pays to measure whether their shuffle can be saved.
MEASURE_FROM = 10_000_000


def sales_joined(
    sales: DataFrame,
    artworks: DataFrame,
    artists: DataFrame,
    how: str = "left",
    measure_from: int = MEASURE_FROM,
) -> DataFrame:
    """Sales with the columns of their artwork and artist, names normalised.

    The artworks meet their artists first, so the sales, the large side, are
    shuffled at most once. Spark does not do so itself: it keeps the order of
    outer joins. From ``measure_from`` sales on (counted from the file footers of
    a stored table; 0 skips the count) the joined artworks are measured, and
    broadcast if they are small; then the sales are not shuffled at all. Otherwise the right side,
    unique by key, lets adaptive execution split a skewed partition of the sales.
    Names are edited once per artist, not once per sale.
    """
    makers = artists.select("artist_id", normalise_name("name").alias("artist_name"), "nationality")
    art = artworks.join(makers, "artist_id", how).select(
        "artwork_id",
        "title",
        "artist_id",
        F.col("year").alias("artwork_year"),
        "medium",
        F.col("price_usd").alias("list_price_usd"),
        "artist_name",
        "nationality",
    )
    if not sales.isStreaming and (measure_from <= 0 or sales.count() >= measure_from):
        art = broadcast_if_small(art)
    return sales.join(art, "artwork_id", how).select(
        "sale_id",
        "artwork_id",
        "sale_date",
        "sale_price_usd",
        "buyer_country",
        *[c for c in art.columns if c != "artwork_id"],
    )


def sales_transform(
    sales: DataFrame,
    artworks: DataFrame,
    artists: DataFrame,
    how: str = "left",
    ordered: bool = True,
) -> DataFrame:
    """Sales with price difference, percent change and normalised artist name.

    Newest first, then by id. Pass ``ordered=False`` where a later step sorts or
    aggregates anyway: it saves the range shuffle.
    """
    enriched = sales_joined(sales, artworks, artists, how).withColumns(
        {
            "price_diff": price_difference("sale_price_usd", "list_price_usd"),
            "pct_change": percent_change("sale_price_usd", "list_price_usd"),
        }
    )
    return sort_rows(enriched, "sale_date desc", "sale_id") if ordered else enriched


def store_for_sales(sales: DataFrame, artworks: DataFrame, folder: str, prefix: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Sales and artworks as tables of ``buckets`` by ``artwork_id``, ``{prefix}_sales`` and ``{prefix}_artworks``.

    Write them once at the harvest: ``sales_colocated`` then joins them as often
    as asked without moving a sale.
    """
    return tuple(
        write_bucketed(df, f"{prefix}_{name}", "artwork_id", buckets, f"{folder}/{name}")
        for name, df in (("sales", sales), ("artworks", artworks))
    )


def sales_colocated(sales: DataFrame, artworks: DataFrame, artists: DataFrame) -> DataFrame:
    """``sales_transform``, unordered, of tables of ``store_for_sales``.

    Sales meet artworks bucket by bucket. The artists are broadcast if they are
    measured to be small, so that nothing is shuffled; otherwise the joined
    sales are shuffled once, by artist.
    """
    makers = artists.select("artist_id", normalise_name("name").alias("artist_name"), "nationality")
    art = artworks.select(
        "artwork_id", "title", "artist_id", F.col("year").alias("artwork_year"), "medium", F.col("price_usd").alias("list_price_usd")
    )
    joined = sales.join(art, "artwork_id", "left").join(broadcast_if_small(makers), "artist_id", "left")
    return joined.select(
        "sale_id", "artwork_id", "sale_date", "sale_price_usd", "buyer_country",
        *[c for c in art.columns if c != "artwork_id"], "artist_name", "nationality",
    ).withColumns(
        {
            "price_diff": price_difference("sale_price_usd", "list_price_usd"),
            "pct_change": percent_change("sale_price_usd", "list_price_usd"),
        }
    )


def sales_output(transformed: DataFrame, minimum=HIGH_VALUE_MINIMUM) -> DataFrame:
    """The sales of at least ``minimum``; the filter reaches the scan of the sales."""
    return filter_number(transformed, "sale_price_usd", minimum, ">=")


def sales_by_threshold(
    sales: DataFrame, artworks: DataFrame, artists: DataFrame, minimum=HIGH_VALUE_MINIMUM
) -> DataFrame:
    """The variant that filters first and keeps raw percentages.

    Inner joins, sales strictly above ``minimum``, an unrounded percent change
    that follows floating point at a zero list price, and no order.
    """
    price, base = F.col("sale_price_usd"), F.col("list_price_usd")
    change = (price - base) / F.nullif(base.cast("double"), F.lit(0.0)) * F.lit(100.0)
    at_zero = (
        F.when(price > base, F.lit(float("inf")))
        .when(price < base, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )
    joined = sales_joined(sales, artworks, artists, "inner")
    return filter_number(joined, "sale_price_usd", minimum, ">").withColumns(
        {
            "price_diff": price_difference(price, base),
            "pct_change": F.when((base == 0) & price.isNotNull(), at_zero).otherwise(change),
        }
    )
