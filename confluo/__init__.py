"""confluo: entity resolution, deduplication and enrichment as Spark plans."""
