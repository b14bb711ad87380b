"""tiffin — a Spark-native batch analytics engine for food-delivery data.

Raw restaurant / customer / order / item / payment / delivery / review
tables go through declarative validation with quarantine, cleaning,
a star schema with dense surrogate keys, declarative data tests and a
library of KPI queries.  Every operator is a function from DataFrames to
a DataFrame; nothing is collected to the driver.
"""

from tiffin.session import get_session, shared_dir  # noqa: F401

__all__ = ["get_session", "shared_dir"]

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers by value, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
