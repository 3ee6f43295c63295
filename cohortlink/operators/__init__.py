"""DataFrame -> DataFrame operators (intake, reshape, quality, counts, extract, linkage, store)."""
