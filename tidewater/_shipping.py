"""Ship task-side Python with the task.

Functions that run inside Python workers (the Arrow hash UDF, the archive
reader) are pickled by value, so executors do not need this package on
their import path -- a cluster only needs pyspark, numpy and pandas.
"""

from __future__ import annotations

import sys


def by_value(module_name: str) -> None:
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[module_name])
    except Exception:  # pragma: no cover - older cloudpickle: fall back to by-reference
        pass
