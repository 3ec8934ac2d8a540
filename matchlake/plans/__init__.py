"""Model functions (staging → intermediate → marts), ingest jobs and the
query catalogue that runs them over the benchmark tables."""
