"""memberlens: membership and monitoring analytics on Spark."""

import sys as _sys

try:
    # Functions this package hands to Python workers (mapInPandas,
    # applyInPandas, applyInPandasWithState, foreachBatch) are pickled by
    # value, so executors run them without the package being installed.
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older pyspark: ship the package with --py-files
    pass
