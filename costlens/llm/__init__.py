"""Training-data operators: filters, near-duplicate search, tokenising and packing.

Nothing else in the library imports this subpackage. The registered queries
are in ``costlens.llm.queries``; each operator has its own module and a
general interface, the query derives its digest columns from it.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
