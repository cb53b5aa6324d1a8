"""Training-data operators: quality, chat formatting, near-dedup, search, tokens, licences, mixing, PII.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# The functions that run inside tasks travel with the job, so executors need
# no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
