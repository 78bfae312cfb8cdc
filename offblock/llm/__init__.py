"""Training-data operators: fingerprints, filters, joins, scoring, packing.

Nothing outside this package imports it. Code that runs inside Python tasks is
pickled by value, so executors need no install of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
