"""placeloom: location analytics expressed as Spark DataFrame plans.

Functions of this package travel to the executors by value, so these need no copy of it on their path.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
