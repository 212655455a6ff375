"""Training-data operators: each module is one operator, ``registry`` holds their queries.

Task code of this package travels with the job, so executors need not have the
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
