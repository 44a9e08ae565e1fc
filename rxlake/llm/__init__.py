"""Training-data operators (dedup, licence scan, quality, mixing, packing, LM).

Nothing else in the package imports this subpackage; deleting it leaves the
analytics engine whole.  Python code of this subpackage that runs in tasks is
pickled by value, so executors need only the public libraries.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
