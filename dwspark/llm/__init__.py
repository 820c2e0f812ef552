"""Training-data operators: formatting, sharding, language, extraction, quality, deduplication,
decontamination, licences and mixing. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
