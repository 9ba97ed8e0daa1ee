"""Training-data operators: filtering, formatting, deduplication, mixing and token output.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries only
when it is present.
"""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this subpackage by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
