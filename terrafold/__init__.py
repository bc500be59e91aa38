"""Geometry tables on Spark: encodings, layout, clustering, catalog and checks as DataFrame jobs.

Functions of this package that run inside Spark tasks travel with the job, so a
cluster needs pyarrow and numpy on its workers but no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
