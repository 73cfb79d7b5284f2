"""Training-data operators on documents, pages and conversations.

Nothing outside this package imports it. Functions that run in Python workers
are pickled by value. Models are broadcast as objects, so on a cluster the
package is shipped with ``spark-submit --py-files``; local sessions do it by
themselves.
"""

import sys

from pyspark import cloudpickle

# This package alone: how the rest of the library ships its functions stays as it is.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
