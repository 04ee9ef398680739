"""Error and user-session telemetry as ordinary Spark plans.

``functions``  row-local Column expressions
``sources``    schemas, readers and writers
``operators``  DataFrame -> DataFrame operators (windows, joins, ordered scans)
``plans``      the composed error flows and the registered queries
``streaming``  Structured Streaming forms of the same operators
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Batch functions travel to the executors by value, so the package needs to
# be installed only where the driver runs.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
