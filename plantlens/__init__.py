"""plantlens: plant-day diagnostics for fleets of solar plants, as Spark jobs.

Every operator is ``DataFrame -> DataFrame`` with ``site_id`` as an ordinary
column, so one job covers any number of plants.
"""

import sys

from pyspark import cloudpickle

# task functions travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
