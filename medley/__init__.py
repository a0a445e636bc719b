"""medley: declared-schema Parquet tables, exact distributed medians, metric-sample
analysis (batch and streaming) and a checked SQL function registry, built on
Spark DataFrame / SQL / Structured Streaming."""

import sys as _sys

__version__ = "0.1.0"

# Python functions that run on executors (pandas UDFs, mapInPandas, stream
# state) are shipped by value, so executors need no installed copy of medley.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: install medley on executors
    pass
