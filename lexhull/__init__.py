"""Spark-native operators for versioned catalogues and the rule texts attached to them.

The few functions that run in Spark's Python workers are shipped by value, so executors need
nothing but the installed libraries.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
