"""Training-data operators: dedup, tokenising, search, extraction, filters, mixing.

Nothing outside this package, ``corpus_pipeline.py`` and the guarded import in
``__spark_entry__.py`` refers to it.
"""

import sys

from pyspark import cloudpickle

# The functions that run inside tasks travel with the job, so executors need
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
