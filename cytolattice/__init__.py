"""cytolattice: spatial cell-assay analytics as Spark DataFrame operators.

Every operator is a plain function from DataFrames to a DataFrame.  Sub-packages:

* ``sources``   readers and writers for the assay's flat files and tables
* ``functions`` column expressions shared by the operators
* ``operators`` the joins, aggregates, windows and iterations
* ``plans``     bindings over the test tables and the registered queries
* ``streaming`` file-stream ingestion into an upserted table
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Kernels used inside tasks travel with the job, so executors need no installed copy of the package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
