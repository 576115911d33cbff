"""statlake: Spark-native processing of landed official-statistics API responses.

The library turns landed JSON response pages (paged data cubes, code lists,
catalogue listings) into analysis-ready DataFrames, entirely with DataFrame /
Spark SQL / Structured Streaming operators so Catalyst plans the work.

Sub-packages:

* ``sources``   -- readers for landed response pages and JSON flattening
* ``functions`` -- column expressions (value/annotation split, redaction, codes)
* ``operators`` -- decode joins, filters, paging, pivot, search, geometry, quality
* ``plans``     -- end-to-end pipelines (tidy/coded results) and reference tables
* ``streaming`` -- exactly-once ingestion of newly landed pages
"""

from statlake.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
__version__ = "0.1.0"
