"""End-to-end pipelines, reference tables and test-data adapters."""
