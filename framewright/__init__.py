"""Paired-frame curation on Spark: match, de-duplicate and batch time-stamped observations with DataFrame plans."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: functions that reach them are sent by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
