"""Operations of a training-data pipeline: cleaning, near duplicates, decontamination, mixing and token output.

Functions that run in tasks are shipped by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
