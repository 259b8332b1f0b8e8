"""The enriched tables on small inputs, and what their variants do differently."""

import json
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from tablewright import plans
from tablewright.errors import CheckFailed
from tablewright.operators.diff import diff_tables
from tablewright.plans.checked import SALES_CONTRACT, checked_sales_output
from tablewright.plans.catalogue import MEDIA_FIELDS
from tablewright.plans.sales import sales_joined
from tablewright.quality.schema import validate

SALES = "sale_id long, artwork_id long, sale_date string, sale_price_usd long, buyer_country string"
ARTWORKS = "artwork_id long, title string, artist_id long, year double, medium string, price_usd long"
ARTISTS = "artist_id long, name string, nationality string"
MEDIA = (
    "artwork_id long, sort_order int, filename string, media_type string, file_format string, "
    "width_px int, height_px int, file_size_kb int, alt_text string"
)


@pytest.fixture
def sales(frame):
    return frame(
        SALES,
        (1, 101, "2022-01-01", 40_000_000, "US"),
        (2, 102, "2010-01-01", 30_000_000, "FR"),
        (3, 101, "2022-01-01", 200_000, "US"),
        (4, 999, "2030-05-01", 50_000_000, "DE"),
        (5, 103, "2001-01-01", 40_200_000, "US"),
    )


@pytest.fixture
def artworks(frame):
    return frame(
        ARTWORKS,
        (101, "Orchard", 1, 1972.0, "watercolor", 600_000),
        (102, "Day", 1, None, "tempera", 3_000_000),
        (103, "Narrows", 2, 1960.0, "tempera", 0),
        (104, "Off Shore", 7, 1967.0, "oil", 500_000),
    )


@pytest.fixture
def artists(frame):
    return frame(ARTISTS, (1, "  Alice Smith \t", "American"), (2, "Bob Jones", "British"))


@pytest.fixture
def media(frame):
    return frame(
        MEDIA,
        (101, 2, "b.jpg", "image", "jpg", 10, 10, 5, "second"),
        (101, 1, "z.jpg", "image", "jpg", 10, 10, 5, "other first"),
        (101, 1, "a.jpg", "image", "jpg", 10, 10, 5, None),
        (102, 3, "c.jpg", "image", "jpg", 10, 10, None, "third"),
    )


def test_sales_transform(sales, artworks, artists, rows):
    out = plans.sales_transform(sales, artworks, artists)
    assert out.columns == list(plans.SALES_SCHEMA.fields)
    found = rows(out, True)
    assert [r[0] for r in found] == [4, 1, 3, 2, 5]
    first = dict(zip(out.columns, found[1]))
    assert first["artist_name"] == "ALICE SMITH" and first["price_diff"] == 39_400_000
    assert first["pct_change"] == 6566.7
    unknown = dict(zip(out.columns, found[0]))
    assert unknown["title"] is None and unknown["pct_change"] is None
    at_zero = dict(zip(out.columns, found[4]))
    assert at_zero["price_diff"] == 40_200_000 and at_zero["pct_change"] is None
    assert plans.sales_transform(sales, artworks, artists, how="inner").count() == 4


def test_sales_output_keeps_the_bound(sales, artworks, artists, rows):
    out = plans.sales_output(plans.sales_transform(sales, artworks, artists))
    assert [r[0] for r in rows(out, True)] == [4, 1, 2, 5]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") > plan.index("Join")  # below the join


def test_sales_variant(sales, artworks, artists, rows):
    out = plans.sales_by_threshold(sales, artworks, artists)
    found = {r[0]: dict(zip(out.columns, r)) for r in rows(out)}
    assert set(found) == {1, 5}
    assert found[5]["pct_change"] == float("inf")
    assert found[1]["pct_change"] == (40_000_000 - 600_000) / 600_000 * 100


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_artworks_transform(artworks, artists, sales, media, rows, limit):
    out = plans.artworks_transform(artworks, artists, sales, media, single_task_rows=limit)
    assert out.columns == [*plans.ARTWORKS_SCHEMA.fields, "media"]
    found = rows(out, True)
    named = {r[0]: dict(zip(out.columns, r)) for r in found}
    # equal totals share a rank and are ordered by id
    assert [(r[0], named[r[0]]["sales_rank"]) for r in found] == [(101, 1), (103, 1), (102, 3), (104, 4)]
    one, four = named[101], named[104]
    assert one["artist_name"] == "  ALICE SMITH \t"
    assert (one["sale_count"], one["total_sales_value"], one["avg_sale_price"]) == (2, 40_200_000, 20_100_000.0)
    assert (one["primary_image"], one["primary_image_alt"], one["media_count"]) == ("a.jpg", None, 3)
    assert [m[:2] for m in one["media"]] == [(1, "a.jpg"), (1, "z.jpg"), (2, "b.jpg")]
    assert (four["has_sold"], four["sale_count"], four["avg_sale_price"]) == (False, 0, None)
    assert (four["media_count"], four["media"], four["artist_name"]) == (0, None, None)
    assert (named[102]["primary_image"], named[102]["media_count"]) == (None, 1)
    assert [named[i]["price_tier"] for i in (103, 104, 101, 102)] == ["budget", "mid", "mid", "premium"]
    assert out.schema["media"].dataType.elementType.names == list(MEDIA_FIELDS)


def test_ordinal_ranks_and_tiers(artworks, artists, sales, media, rows):
    _, tiers = plans.artworks_output(plans.artworks_transform(artworks, artists, sales, media))
    assert rows(tiers) == [("budget", 1), ("mid", 2), ("premium", 1)]
    for limit in (1_000_000, 1):
        out = plans.artworks_transform(
            artworks, artists, sales, media, ties="ordinal", single_task_rows=limit
        )
        assert [r.sales_rank for r in out.collect()] == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        plans.artworks_transform(artworks, artists, sales, media, ties="dense")


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_artworks_variant(artworks, artists, sales, media, rows, limit):
    out = plans.artworks_by_tier(artworks, artists, sales, media, single_task_rows=limit)
    named = {r[0]: dict(zip(out.columns, r)) for r in rows(out)}
    assert set(named) == {101, 102, 103} and "media" not in out.columns
    assert named[102]["price_tier"] == "mid" and named[101]["artist_name"] == "ALICE SMITH"
    assert [named[i]["sales_rank"] for i in (101, 102, 103)] == [1, 2, 1]
    # image and caption are picked separately here
    assert (named[101]["primary_image"], named[101]["primary_image_alt"]) == ("a.jpg", "other first")
    assert named[103]["media_count"] is None


def test_unsold_artworks_have_no_flag_in_the_variant(artworks, artists, sales, media):
    out = plans.artworks_by_tier(artworks, artists, sales.limit(0), media)
    assert {r.has_sold for r in out.collect()} == {None}


def test_empty_inputs(frame):
    s, w, a, m = frame(SALES), frame(ARTWORKS), frame(ARTISTS), frame(MEDIA)
    assert plans.sales_transform(s, w, a).count() == 0
    assert plans.artworks_transform(w, a, s, m).count() == 0
    assert plans.artworks_by_tier(w, a, s, m).count() == 0


def test_results_meet_their_schemas(sales, artworks, artists, media):
    known = sales.filter("artwork_id != 999")
    assert validate(plans.sales_transform(known, artworks, artists), plans.SALES_SCHEMA).error_count == 1
    table = plans.artworks_transform(artworks.filter("artist_id < 3"), artists, sales, media)
    assert validate(table, plans.ARTWORKS_SCHEMA).error_count == 1  # the list price of zero


def test_checked_output(sales, artworks, artists, folder):
    good = plans.sales_transform(
        sales.filter("artwork_id IN (101, 102)"), artworks, artists, ordered=False
    )
    result = checked_sales_output(good, folder())
    lines = [json.loads(x) for f in Path(folder()).glob("part-*") for x in f.read_text().splitlines()]
    assert result.rows == len(lines) == 2
    assert list(lines[0])[-1] == "price_difference" and "price_diff" not in lines[0]
    bad = plans.sales_transform(sales, artworks, artists)
    with pytest.raises(CheckFailed):
        checked_sales_output(bad, folder("never"))
    assert not Path(folder("never")).exists()
    assert len(SALES_CONTRACT.checks) == 7


def test_measured_artworks_give_the_same_sales(sales, artworks, artists):
    plain = sales_joined(sales, artworks, artists)
    measured = sales_joined(sales, artworks, artists, measure_from=0)
    assert "strategy=broadcast" in measured._jdf.queryExecution().optimizedPlan().toString()
    assert diff_tables(plain, measured).matches()


def test_dates_are_text_unless_said_to_be_iso(sales, artworks, artists, media):
    odd = sales.withColumn("sale_date", F.concat(F.lit("on "), "sale_date"))
    plain = plans.artworks_transform(artworks, artists, sales, media).filter("artwork_id = 101").first()
    found = plans.artworks_transform(artworks, artists, odd, media).filter("artwork_id = 101").first()
    assert found.first_sale_date == "on " + plain.first_sale_date
    assert found.last_sale_date == "on " + plain.last_sale_date
    iso = plans.artworks_transform(artworks, artists, sales, media, iso_dates=True)
    assert diff_tables(plans.artworks_transform(artworks, artists, sales, media).drop("media"), iso.drop("media")).matches()
    with pytest.raises(Exception, match="not an ISO date"):
        plans.artworks_transform(artworks, artists, odd, media, iso_dates=True).collect()


def test_tiers_do_not_sort_all_media(artworks, artists, sales, media):
    out = plans.artworks_by_tier(artworks, artists, sales, media, iso_dates=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    counts = [line for line in plan.splitlines() if "SortAggregate" in line and "count(" in line]
    assert not counts


def test_media_in_parts(media, artworks, artists, sales, rows):
    parts = plans.media_parts(media, part_rows=2, single_task_rows=1)
    assert [(r[0], r[1], [m[1] for m in r[2]]) for r in rows(parts)] == [
        (101, 0, ["a.jpg", "z.jpg"]), (101, 1, ["b.jpg"]), (102, 0, ["c.jpg"])
    ]
    bare = plans.artworks_transform(artworks, artists, sales, media, media_lists=False)
    full = plans.artworks_transform(artworks, artists, sales, media).drop("media")
    assert diff_tables(full, bare).matches()


def test_join_order_shuffles_the_sales_once(sales, artworks, artists, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = plans.sales_transform(sales, artworks, artists, ordered=False)
        plan = out._jdf.queryExecution().executedPlan().toString()
        # sales, artworks, artists, and artworks once more by their own key
        assert plan.count("Exchange hashpartitioning") == 4
        fact = plan[: plan.index("SortMergeJoin [artist_id")]
        assert fact.count("Exchange hashpartitioning(artwork_id") >= 1
        same = out.join(out.select("sale_id"), "sale_id", "left_semi")
        assert diff_tables(out, same).matches()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
