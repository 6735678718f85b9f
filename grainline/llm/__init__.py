"""Training-data operators: formatting, deduplication, classification, mixing and decontamination.

What runs inside tasks travels by value, so executors need numpy, pyarrow and xxhash but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
