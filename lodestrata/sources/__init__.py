from lodestrata.sources.drops import MalformedDrop, drop_manifest, manifest_issues, read_drop, read_drop_parts
from lodestrata.sources.tables import catalog_view, mapping, publish, published_catalog_view, published_view, read_model
from lodestrata.sources.versions import read_published, read_release, release, write_version

__all__ = [
    "MalformedDrop",
    "catalog_view",
    "drop_manifest",
    "manifest_issues",
    "mapping",
    "publish",
    "published_catalog_view",
    "published_view",
    "read_drop",
    "read_drop_parts",
    "read_model",
    "read_published",
    "read_release",
    "release",
    "write_version",
]
