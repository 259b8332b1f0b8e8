"""Search documents, sitemaps, manifests and enrichment."""

import json

from pyspark.sql import functions as F

from gates.registry import query
from tablewright import publishing as P
from tablewright.session import fresh_path
from tablewright.sources import clean_numbers

BASE = "https://example.org/items/"


@query(
    """
    SELECT 'test-parts' AS _index, CAST(p_partkey AS VARCHAR) AS _id,
           CAST(to_json({'p_partkey': p_partkey, 'p_name': p_name, 'size': nullif(p_size, 7)})
             AS VARCHAR) AS _source
    FROM part
    """
)
def x1_search_documents(t):
    parts = t.part.select("p_partkey", "p_name", F.nullif("p_size", F.lit(7)).alias("size"))
    return P.search_documents(parts, "parts", prefix="test-", id_field="p_partkey")


@query(
    """
    SELECT 'docs' AS "index", count(*) FILTER (WHERE doc_id % 7 > 0) AS sent,
           count(*) FILTER (WHERE doc_id % 7 = 0) AS refused,
           CAST(sum(doc_id) FILTER (WHERE doc_id % 7 = 0) AS BIGINT) AS refused_ids FROM documents
    """
)
def x2_bulk_batches(t):
    documents = P.search_documents(t.documents, "docs", id_field="doc_id")

    def receive(items):
        # a stand-in for a search service, which names what it refuses
        return [i["_id"] for i in items if json.loads(i["_source"])["doc_id"] % 7 == 0]

    batches = P.bulk_batches(documents, receive, batch_size=100)
    ids = F.aggregate("failed_ids", F.lit(0).cast("long"), lambda s, i: s + i.cast("long"))
    return batches.groupBy("index").agg(
        F.sum("sent").alias("sent"), F.sum("failed").alias("refused"), F.sum(ids).alias("refused_ids")
    )


@query(
    """
    SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE value END AS value
    FROM events
    """
)
def x3_clean_numbers(t):
    value = (
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .when(F.col("event_type") == "signup", F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    return clean_numbers(t.events.select("event_id", value.alias("value")))


def _urls(t):
    pages = t.pages.select(
        F.regexp_replace("url", "^https?:/", "").alias("path"),
        F.timestamp_add("DAY", F.col("page_id").cast("int"), F.lit("2020-01-01").cast("timestamp")).alias("seen"),
        F.when(F.col("page_id") % 3 == 0, "daily").otherwise("monthly").alias("freq"),
    )
    return P.sitemap_urls(pages, "path", BASE, "seen", "freq", 0.5)


_URLS = f"""
urls AS (
  SELECT '{BASE}' || ltrim(regexp_replace(url, '^https?:/', ''), '/') AS loc,
         strftime(DATE '2020-01-01' + CAST(page_id AS INTEGER), '%Y-%m-%d') AS lastmod,
         CASE WHEN page_id % 3 = 0 THEN 'daily' ELSE 'monthly' END AS changefreq, '0.5' AS priority
  FROM pages)"""


@query(f"WITH {_URLS} SELECT * FROM urls")
def x4_sitemap_urls(t):
    return _urls(t)


@query(
    f"""
    WITH {_URLS}
    SELECT urls.*, CAST(ceil(row_number() OVER (ORDER BY loc COLLATE C) / 40.0) AS INTEGER) AS shard
    FROM urls
    """.replace(" COLLATE C", "")
)
def x5_sitemap_files(t):
    path = fresh_path(t.spark, "sitemaps")
    P.write_sitemaps(_urls(t), path, max_urls=40)
    schema = "loc string, lastmod string, changefreq string, priority string"
    reader = t.spark.read.format("xml").option("rowTag", "url")
    return reader.schema(schema).load(path).select(
        "loc", "lastmod", "changefreq", "priority", F.col("shard").cast("int").alias("shard")
    )


_IMAGES = f"""
images AS (
  SELECT '{BASE}' || conv_id AS loc, '{BASE}' || conv_id || '-' || turn || '.jpg' AS image,
         role AS title, text AS caption FROM conversations)"""


def _image_rows(t):
    return t.conversations.select(
        F.col("conv_id").cast("string").alias("page"),
        F.concat_ws("-", "conv_id", F.concat("turn", F.lit(".jpg"))).alias("image"),
        "role",
        "text",
    )


@query(
    f"""
    WITH {_IMAGES}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY loc ORDER BY image) AS n FROM images)
    SELECT loc, count(*) AS n, string_agg(image || ' ' || title || ' ' || caption, ',' ORDER BY image)
             AS images
    FROM numbered GROUP BY loc, ceil(n / 3.0)
    """
)
def x6_image_sitemap(t):
    urls = P.image_urls(
        _image_rows(t),
        "page",
        "image",
        BASE,
        optional={"title": "role", "caption": "text"},
        images_per_url=3,
    )
    text = F.transform("images", lambda i: F.concat_ws(" ", i["loc"], i["title"], i["caption"]))
    return urls.select(
        "loc", F.size("images").cast("long").alias("n"), F.array_join(text, ",").alias("images")
    )


@query(
    f"""
    WITH {_IMAGES} SELECT loc, image, title FROM images
    """
)
def x6_image_sitemap_files(t):
    urls = P.image_urls(_image_rows(t), "page", "image", BASE, optional={"title": "role"})
    path = fresh_path(t.spark, "image-sitemaps")
    P.write_image_sitemaps(urls, path, max_urls=30)
    schema = "loc string, `image:image` array<struct<`image:loc`:string,`image:title`:string>>"
    read = t.spark.read.format("xml").option("rowTag", "url").schema(schema).load(path)
    return read.select("loc", F.explode("`image:image`").alias("i")).select(
        "loc", F.col("i.`image:loc`").alias("image"), F.col("i.`image:title`").alias("title")
    )


@query(
    f"""
    WITH {_URLS}, numbered AS (
      SELECT *, CAST(ceil(row_number() OVER (ORDER BY loc) / 40.0) AS INTEGER) AS shard FROM urls)
    SELECT 'https://example.org/maps/' || printf('sitemap-%05d.xml', shard) AS loc,
           max(lastmod) AS lastmod FROM numbered GROUP BY shard
    """
)
def x7_sitemap_index(t):
    shards = P.write_sitemaps(_urls(t), fresh_path(t.spark, "sitemaps"), max_urls=40)
    path = fresh_path(t.spark, "sitemap-index")
    P.write_sitemap_index(P.sitemap_index(shards, "https://example.org/maps"), path)
    reader = t.spark.read.format("xml").option("rowTag", "sitemap")
    return reader.schema("loc string, lastmod string").load(path).select("loc", "lastmod")


def _tiles(t):
    return t.part.select(
        F.col("p_partkey").alias("id"),
        (F.col("p_partkey") * 7 + 1).cast("int").alias("width"),
        (F.col("p_size") * 300).alias("height"),
    )


# the whole document, with @n for the image's address and @w for its size
_MANIFEST = (
    '{"@context":"http://iiif.io/api/presentation/3/context.json","id":"@n/manifest.json",'
    '"type":"Manifest","label":{"en":["@t"]},'
    '"metadata":[{"label":{"en":["Artist"]},"value":{"en":["@a"]}}],'
    '"items":[{"id":"@n/canvas","type":"Canvas",@w,'
    '"items":[{"id":"@n/page","type":"AnnotationPage",'
    '"items":[{"id":"@n/annotation","type":"Annotation","motivation":"painting",'
    '"body":{"id":"@n/full/max/0/default.jpg","type":"Image","format":"image/jpeg",'
    '"service":[{"id":"@n","type":"ImageService3","profile":"level2",@w}],@w},'
    '"target":"@n/canvas"}]}]}]}'
)


@query(
    f"""
    SELECT p_partkey AS id,
           replace(replace(replace(replace('{_MANIFEST}',
             '@n', 'https://example.org/iiif/' || p_partkey),
             '@w', '"width":' || (p_partkey * 7 + 1) || ',"height":' || (p_size * 300)),
             '@t', coalesce(s_name, 'Artwork ' || p_partkey)),
             '@a', coalesce(CAST(s_nationkey AS VARCHAR), 'Unknown')) AS manifest
    FROM part LEFT JOIN supplier ON p_partkey = s_suppkey
    """
)
def x8_image_manifests(t):
    metadata = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"), "s_nationkey")
    return P.image_manifests(
        _tiles(t), metadata, "id", "https://example.org/iiif/", labels={"Artist": "s_nationkey"}
    )


@query(
    """
    SELECT id, CAST(min(z) AS INTEGER) AS zoom
    FROM (SELECT p_partkey AS id, greatest(p_partkey * 7 + 1, p_size * 300) AS longest FROM part),
         range(0, 40) r(z)
    WHERE 256 * (CAST(1 AS BIGINT) << CAST(z AS INTEGER)) >= longest GROUP BY id
    """
)
def x9_zoom_level(t):
    return _tiles(t).select("id", P.zoom_level("width", "height").alias("zoom"))


def _letter_counts(texts):
    """A deterministic stand-in for an embedding service: letters counted, a token a text."""
    return [[float(text.count(c)) for c in "aeinorst"] for text in texts], len(texts)


@query(
    """
    SELECT CAST(doc_id AS VARCHAR) AS embedding_id, text, 'letters' AS model,
           CAST(8 AS BIGINT) AS dimensions, CAST(1 AS BIGINT) AS total_tokens,
           array_to_string([CAST(length(text) - length(replace(text, c, '')) AS BIGINT) FOR c IN
             ['a', 'e', 'i', 'n', 'o', 'r', 's', 't']], ',') AS counts FROM documents
    """
)
def x10_batch_enrichment(t):
    enriched = P.embed_texts(t.documents, "text", _letter_counts, "letters", id_column="doc_id")
    counts = F.array_join(F.transform("embedding", lambda x: x.cast("long").cast("string")), ",")
    return enriched.select(
        "embedding_id", "text", "model", "dimensions", "total_tokens", counts.alias("counts")
    )


@query(
    """
    SELECT doc_id, text, 'letters' AS model, CAST(8 AS BIGINT) AS dimensions,
           array_to_string([CAST(length(text) - length(replace(text, c, '')) AS VARCHAR) FOR c IN
             ['a', 'e', 'i', 'n', 'o', 'r', 's', 't']], ',') AS counts FROM documents
    """
)
def x10_paid_once(t):
    """The second run finds every text of the first in the store."""
    store, docs = fresh_path(t.spark, "vectors"), t.documents.select("doc_id", "text")
    for _ in range(2):
        enriched = P.embed_once(docs, "text", _letter_counts, "letters", store)
    counts = F.array_join(F.transform("embedding", lambda x: x.cast("long").cast("string")), ",")
    return enriched.select("doc_id", "text", "model", "dimensions", counts.alias("counts"))
