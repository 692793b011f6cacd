"""DataFrame -> DataFrame steps: reshape, quality, enrich, medians, winners, options, pricing."""
