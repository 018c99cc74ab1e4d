"""Road-condition analytics as Spark jobs: raw events to clean tables to scores."""
