"""Ordered dataset pipelines and feature preparation on Spark."""

import sys

from pyspark import cloudpickle

from ordinate.features import feature_spec, scaler_min_max, scaler_standard, use_spec  # noqa: F401
from ordinate.operators import *  # noqa: F401,F403
from ordinate.order import Ordinal, check_order, with_ordinal  # noqa: F401
from ordinate.sources import *  # noqa: F401,F403

# tasks carry the functions they run, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
