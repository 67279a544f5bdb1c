"""Operators for preparing training data at scale.

Nothing else in the library imports this package. Functions and classes of the
package are pickled by value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
