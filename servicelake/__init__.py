"""servicelake: Spark-native service-request lakehouse operators.

Every operator takes and returns lazy ``DataFrame`` objects; nothing here
collects unbounded data to the driver.  Sub-packages:

* ``sources``   - table scans, seeds, fixture views and sinks
* ``functions`` - column expressions (parsing, normalisation, SLA flags)
* ``operators`` - relational operators (keys, SLA facts, merge, quality,
  drift, layout, verification, benchmark queries)
* ``plans``     - end-to-end pipelines composed from the operators
* ``streaming`` - Structured Streaming ingestion
"""

__version__ = "0.1.0"
__all__ = ["session"]
