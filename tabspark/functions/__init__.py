"""Scalar column functions (JVM-side expressions only)."""
from tabspark.functions.arrays import argmax, confidence, with_log_sum_exp, with_softmax  # noqa: F401
from tabspark.functions.numeric import round4, zero_div  # noqa: F401
