"""Sources: sitemaps, captured responses, markdown corpora, listings and registries."""
