"""Named queries (catalog_* modules) and their registry."""
