"""Search documents, sitemaps, manifests, enrichment and lineage."""

import json
import xml.etree.ElementTree as ET
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablewright import lineage as L
from tablewright import publishing as P
from tablewright.session import stage


def test_search_documents_pick_an_id(frame, rows):
    df = frame("id int, v double, n string", (1, float("nan"), None))
    found = rows(P.search_documents(df, "art", prefix="dev_"))
    assert found == [("dev_art", "1", '{"id":1,"v":null,"n":null}')]
    assert rows(P.search_documents(df, "art", id_field="n"))[0][1] is None
    assert rows(P.search_documents(df.drop("id"), "art"))[0][1] is None
    assert rows(P.search_documents(df.withColumnRenamed("id", "_id"), "art"))[0][1] == "1"


def test_bulk_files_are_bounded_and_whole(spark, folder):
    documents = P.search_documents(spark.range(1050).repartition(2), "n")
    P.write_bulk_files(documents, folder(), batch_size=100)
    files = [f.read_text().splitlines() for f in Path(folder()).glob("part-*")]
    assert max(len(f) for f in files) == 200 and sum(len(f) for f in files) == 2 * 1050
    ids = {json.loads(x)["index"]["_id"] for f in files for x in f[::2]}
    assert ids == {str(i) for i in range(1050)}
    assert {json.loads(x)["id"] for f in files for x in f[1::2]} == set(range(1050))


def test_bulk_batches_are_sent_once_in_full_batches(spark, folder, rows):
    documents = P.search_documents(spark.range(25_100).coalesce(1), "n")
    calls = Path(folder("calls"))
    calls.mkdir()

    def sender(items):
        (calls / f"{items[0]['_id']}-{len(items)}").touch()
        return 0

    batches = P.bulk_batches(documents, sender, batch_size=12_500)
    assert rows(P.bulk_totals(batches)) == [("n", 25_100, 0, 3)] and batches.count() == 3
    assert sorted(int(f.name.split("-")[1]) for f in calls.iterdir()) == [100, 12_500, 12_500]


def test_bulk_batches_count_failures(spark, rows):
    documents = P.search_documents(spark.range(10).coalesce(1), "n")

    def sender(items):
        if items[0]["_id"] == "4":
            raise OSError("down")
        return sum(i["_id"] == "1" for i in items)

    assert rows(P.bulk_batches(documents, sender, batch_size=4)) == [
        ("n", "0", 3, 1, None, None), ("n", "4", 0, 4, ["4", "5", "6", "7"], "OSError: down"),
        ("n", "8", 2, 0, None, None),
    ]
    named = P.bulk_batches(documents, lambda items: [i["_id"] for i in items[:1]], batch_size=6)
    assert [r[2:5] for r in rows(named)] == [(5, 1, ["0"]), (3, 1, ["6"])]


def test_url_joins_have_one_slash(frame, rows):
    df = frame("p string", ("/a",), ("a",), ("//a/b",))
    assert rows(df.select(P.join_url("https://x.org/", "p")), True) == [
        ("https://x.org/a",), ("https://x.org/a",), ("https://x.org/a/b",)
    ]
    assert rows(df.select(P.join_url("", "p")), True)[0] == ("/a",)


def test_sitemap_urls(frame, rows):
    df = frame(
        "slug string, seen timestamp, day string, prio double, freq string",
        ("a", datetime(2024, 1, 15, 10), "", 0.75, "daily"),
        ("b", None, "2024-02", 0.5, "never"),
    )
    out = P.sitemap_urls(df, "slug", "https://x.org", "seen", "freq", "prio")
    assert rows(out) == [
        ("https://x.org/a", "2024-01-15", "daily", "0.75"), ("https://x.org/b", None, "never", "0.5")
    ]
    out = P.sitemap_urls(df, "slug", lastmod="day", changefreq="monthly", priority="0.8")
    assert rows(out) == [("a", None, "monthly", "0.8"), ("b", "2024-02", "monthly", "0.8")]
    assert P.sitemap_urls(df, "slug").columns == ["loc"]


NS = {"s": "http://www.sitemaps.org/schemas/sitemap/0.9",
      "i": "http://www.google.com/schemas/sitemap-image/1.1"}


def _trees(path):
    return [ET.parse(f).getroot() for f in sorted(Path(path).rglob("part-*.xml"))]


@pytest.mark.parametrize("limit", [1_000_000, 10])
def test_sitemap_files_are_bounded_and_whole(frame, folder, rows, limit):
    df = frame(
        "loc string, lastmod string",
        *[(f"https://x.org/a?b={i:03d}&c", "2024-01-01" if i % 2 else None) for i in range(60)],
        *[("https://x.org/copy", None)] * 45,
    )
    shards = P.write_sitemaps(df, folder(), max_urls=20, single_task_rows=limit)
    assert sorted(rows(shards.select("urls"))) == [(5,)] + [(20,)] * 5
    trees = _trees(folder())
    assert len(trees) == 6 and all(len(t) <= 20 for t in trees)
    locs = [u.find("s:loc", NS).text for t in trees for u in t]
    assert len(locs) == 105 and locs.count("https://x.org/copy") == 45
    index = P.sitemap_index(shards, "https://x.org/maps")
    P.write_sitemap_index(index, folder("index"))
    (root,) = _trees(folder("index"))
    assert root.tag.endswith("sitemapindex") and len(root) == 6
    assert root[0].find("s:loc", NS).text.startswith("https://x.org/maps/sitemap-0000")


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_image_sitemap_splits_large_pages(frame, folder, limit):
    df = frame(
        "page string, img string, t string",
        *[("p1", f"{i:02d}.jpg", f"T{i}") for i in range(7)], ("p2", "x.jpg", None),
    )
    urls = P.image_urls(
        df, "page", "img", "https://x.org", "https://cdn.org/", {"title": "t"}, 3,
        single_task_rows=limit,
    )
    assert sorted((r.loc, len(r.images)) for r in urls.collect()) == [
        ("https://x.org/p1", 1), ("https://x.org/p1", 3), ("https://x.org/p1", 3),
        ("https://x.org/p2", 1),
    ]
    P.write_image_sitemaps(urls, folder())
    (root,) = _trees(folder())
    images = root.findall(".//i:image", NS)
    assert len(root) == 4 and len(images) == 8
    assert images[0].find("i:loc", NS).text == "https://cdn.org/00.jpg"
    assert sum(i.find("i:title", NS) is not None for i in images) == 7


def test_image_sitemaps_are_bounded_by_bytes_and_the_index_by_entries(spark, folder):
    df = spark.range(400).selectExpr("concat('p', id % 8) page", "concat(id, '.jpg') img")
    urls = P.image_urls(df, "page", "img", "https://x.org", images_per_url=10)
    shards = P.write_image_sitemaps(urls, folder(), max_bytes=6000, single_task_rows=5)
    files = list(Path(folder()).rglob("part-*.xml"))
    assert len(files) == shards.count() > 3
    assert all(f.stat().st_size < 2 * 6000 for f in files)
    assert sum(len(t.findall(".//i:image", NS)) for t in _trees(folder())) == 400
    index = P.sitemap_index(shards, "https://x.org")
    P.write_sitemap_index(index, folder("index"), max_entries=2)
    trees = _trees(folder("index"))
    assert all(len(t) <= 2 for t in trees) and sum(len(t) for t in trees) == len(files)


def test_zoom_levels(frame, rows):
    sizes = [(1, 1), (256, 10), (257, 10), (512, 512), (513, 1), (1, 1 << 20), ((1 << 20) + 1, 1)]
    df = frame("w int, h int", *sizes)
    assert [r[0] for r in rows(df.select(P.zoom_level("w", "h")), True)] == [0, 0, 1, 1, 2, 12, 13]


def test_manifests_default_to_unknown(frame, rows):
    tiles = frame("id string, width int, height int", ("a1", 100, 50), ("a2", 10, 20))
    metadata = frame("id string, title string, artist_name string, year int", ("a1", "T", "A", 1900))
    out = dict(rows(P.image_manifests(tiles, metadata, "id", "https://x.org/iiif/")))
    one, two = json.loads(out["a1"]), json.loads(out["a2"])
    assert one["@context"] == "http://iiif.io/api/presentation/3/context.json"
    assert one["label"] == {"en": ["T"]} and two["label"] == {"en": ["Artwork a2"]}
    assert [m["value"]["en"][0] for m in one["metadata"]] == ["A", "1900"]
    assert [m["value"]["en"][0] for m in two["metadata"]] == ["Unknown", "Unknown"]
    body = one["items"][0]["items"][0]["items"][0]["body"]
    assert body["service"][0] == {
        "id": "https://x.org/iiif/a1", "type": "ImageService3", "profile": "level2",
        "width": 100, "height": 50,
    }


def test_embeddings_in_batches_with_one_retry(spark, frame, folder, rows):
    df = frame("k long, t string", *[(i, f"text {i}") for i in range(300)]).coalesce(1)
    sizes = Path(folder("sizes"))
    sizes.mkdir()

    def embed(texts):
        tries = len(list(sizes.iterdir()))
        (sizes / f"{tries}-{len(texts)}").touch()
        if tries == 1:
            raise TimeoutError
        return [[float(len(t)), 1.0] for t in texts], 3 * len(texts) + 1

    out = P.embed_texts(df, "t", embed, "m1", id_column="k", retry_wait=0)
    found = {r.embedding_id: r for r in stage(out).collect()}
    assert len(found) == 300 and found["10"].embedding == [7.0, 1.0]
    assert (found["10"].dimensions, found["10"].total_tokens, found["10"].model) == (2, 3, "m1")
    assert sorted(int(f.name.split("-")[1]) for f in sizes.iterdir()) == [44, 128, 128, 128]
    ordinal = P.embed_texts(df, "t", lambda t: ([[0.0]] * len(t), 0), "m", order_by=["k desc"])
    assert ("embedding_0", "text 299") in rows(ordinal.select("embedding_id", "text"))
    with pytest.raises(ValueError):
        P.embed_texts(df, "t", embed, "m1")
    with pytest.raises(ValueError):
        P.embed_texts(df, "t", embed, "m1", id_column="k", batch_size=0)


def test_column_lineage(spark, frame, rows):
    edges = L.column_lineage(
        spark,
        "out",
        passthrough={"id": "a", "year": "a"},
        rename={"year": ("b", "y")},
        computed={"diff": [("a", "p"), ("b", "q")]},
    )
    assert rows(edges) == [
        ("out", "diff", "a", "p", "computed"), ("out", "diff", "b", "q", "computed"),
        ("out", "id", "a", "id", "passthrough"), ("out", "year", "b", "y", "rename"),
    ]
    passed = L.passthrough_lineage(spark, "o", "s", ["id"], {"new": "old"})
    assert rows(passed) == [
        ("o", "id", "s", "id", "passthrough"), ("o", "new", "s", "old", "rename")
    ]
    report = frame("`column` string, `check` string, failures long", ("diff", "not_nullable", 3))
    assert [r[2:] for r in rows(L.trace_errors(edges, report))] == [
        ("a", "p", "computed", "not_nullable", 3), ("b", "q", "computed", "not_nullable", 3)
    ]


def test_profiles_and_examples(spark, frame, folder, rows):
    df = frame("id int, price double, name string", (1, 86_265_000.0, "x"), (2, 12.5, None))
    assert rows(L.output_statistics(df)) == [(2,)]
    assert rows(L.output_statistics(df, {"top": "max(price)"})) == [(86_265_000.0,)]
    example = L.formatted_example(df, "id", 1, {"cost": "price", "gone": "nope"})
    assert example.columns == ["id", "name", "cost", "gone"]
    assert rows(example) == [("1", "x", "$86.3M", None)]
    found = L.profile(df, 1, {"total": "sum(id)"})
    assert (found["record_count"], found["total"], found["preview"].count()) == (2, 3, 1)
    df.write.parquet(folder())
    assert L.stored_rows(spark, folder()) == 2
    examples = rows(L.raw_examples({"t": df}, {"t": ("id", 2)}))
    assert examples == [("t", "id", "2"), ("t", "name", None), ("t", "price", "$12.50")]
