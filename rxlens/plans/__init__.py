"""Silver and gold pipelines: entities in, one table out."""
