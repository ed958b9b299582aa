"""Operators for training-data pipelines (documents, pages, token files).

Nothing outside this folder imports it; ``queries.py`` registers one query per operator.
"""
import sys

from pyspark import cloudpickle

# functions of this folder travel to the executors by value: they need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
