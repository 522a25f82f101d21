"""eventide: stream and table analytics operators on PySpark.

Operators are plain functions from DataFrames to DataFrames built on the
DataFrame/SQL API, with streaming forms on Structured Streaming.

The few Python steps that run inside tasks (``mapInPandas`` chains and
``transformWithState`` processors) are defined in this package.  It is
registered with PySpark's cloudpickle to be pickled by value, so executors
need not have the package installed or on their path: the functions and
processor classes travel with the task.
"""

import sys as _sys

__version__ = "0.1.0"

try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: ship the package instead
    pass
