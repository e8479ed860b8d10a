"""Spark jobs that turn fetched listing pages into clean, routed, stored records."""
