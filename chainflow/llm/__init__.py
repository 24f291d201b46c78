"""Training-data operators: ten operators, their queries and the corpus pipeline's parts.

Nothing else in the library imports this subpackage.  Its functions are pickled
by value, so executors need no copy of the repository on their path.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
