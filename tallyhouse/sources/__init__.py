"""Raw tables: schemas, CSV scans, seeds, freshness limits and column overrides."""
