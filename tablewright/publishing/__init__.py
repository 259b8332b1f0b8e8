"""Documents for search, sitemaps and image viewers, and batch enrichment."""

from tablewright.publishing.enrichment import ENRICHED_SCHEMA, embed_once, embed_texts
from tablewright.publishing.manifests import image_manifests, zoom_level
from tablewright.publishing.search import (
    bulk_batches,
    bulk_totals,
    write_bulk_files,
    search_documents,
)
from tablewright.publishing.sitemaps import (
    image_urls,
    join_url,
    sitemap_index,
    sitemap_shards,
    sitemap_urls,
    write_image_sitemaps,
    write_sitemap_index,
    write_sitemaps,
)

__all__ = [name for name in dir() if not name.startswith("_")]
