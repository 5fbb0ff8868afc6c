"""commentlens: curation, labelling, classification and reporting of free-text comments on Spark."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this package travel to the Python workers as a whole, so that executors need no copy
# of it.
register_pickle_by_value(sys.modules[__name__])
