"""fleetlake — medallion (bronze → silver → gold) analytics for half-hourly
asset-availability series, written as plain Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column``
for scalar helpers); Catalyst plans and runs them.  Sub-packages:

* ``sources``   – CSV / table / file-inventory readers and the fixture views
* ``sinks``     – table writers (overwrite, partitioned), DDL helpers
* ``functions`` – column expressions: text repair, lenient casts, calendar, flags
* ``operators`` – relational building blocks: keys, pivot, dims, fact, quality, analytics
* ``plans``     – the layered pipeline and the query catalog
* ``streaming`` – incremental (available-now) bronze ingest
"""

from fleetlake.settings import Settings

__all__ = ["Settings"]
