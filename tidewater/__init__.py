"""tidewater: historical sensor/station observations as Spark DataFrame jobs.

Sub-packages:

* ``functions``  column-expression builders (decimal comma, keys, ids, periods, time)
* ``sources``    lookup / fact / entity scans and the binding to the driver tables
* ``operators``  predicates, lookup joins, de-duplication, batching, statistics,
                 upserts and cascade deletes, all DataFrame -> DataFrame
* ``plans``      end-to-end jobs (observation mapping, entity model, report)
* ``sinks``      batch documents, entity folders, sorted rewrites, reconciliation
* ``streaming``  incremental (availableNow) loads that are idempotent by id
"""

from tidewater.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
