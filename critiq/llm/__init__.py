"""Training-data operators.

Nothing outside this package imports it. The functions that run inside tasks
are pickled by value, so executors need numpy, pyarrow and the codec libraries
but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
