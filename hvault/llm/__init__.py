"""Training-data pipeline operators (deduplication, quality, tokenising, packing, secrets, chat).

Functions of this package run inside Python workers; they are pickled by
value, so executors need no copy of the library on their import path.
"""

from pyspark import cloudpickle

import hvault

cloudpickle.register_pickle_by_value(hvault)
