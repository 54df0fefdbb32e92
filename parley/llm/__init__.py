"""Operators for preparing large training corpora (documents in, decisions or encoded files out).

Nothing else in the library imports this subpackage. Each operator has a general
interface in its own module; ``queries.py`` holds the thin registered queries.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
