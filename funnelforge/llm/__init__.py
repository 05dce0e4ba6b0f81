"""Training-data operators: language id, similarity search and joins, page
extraction, licences, toxicity, URL filters, packing, personal data and
benchmark decontamination.

Nothing else in the library imports this subpackage.  Its functions are
pickled by value, so executors need not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
