"""tidemark: incremental bronze / silver / gold loads as Spark jobs.

Start with ``tidemark.api`` (one call per original procedure or view), or
use the pieces directly:

* ``operators``: change windows, tag loaders, gold upsert, run log,
  size-checked broadcasts, split running scans;
* ``plans``: incremental steps, pair discovery, batch drivers, partition
  planning;
* ``sources``: warehouses (in-memory / parquet), keyed parquet tables, a
  query as a source;
* ``streaming``: landing that keeps the high watermark current.
"""

__version__ = "0.1.0"
