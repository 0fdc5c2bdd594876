"""Operators of a training-data pipeline: mixing, deduplication, scans, models and token files.

Every operator reads only the columns it names, so tables may carry others. A null text counts
as an empty one and a null id sorts after all others unless a docstring says otherwise.
"""

import sys

from pyspark import cloudpickle

# Tasks carry the functions they run, so executors need numpy, pyarrow, xxhash and tokenizers but
# not this package itself.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
