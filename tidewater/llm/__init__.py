"""Training-data operators: each module holds one, ``queries`` registers them."""

from pyspark import cloudpickle

import tidewater.llm as _self

# Functions run by executors travel by value, so a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(_self)
