"""Resolution of hand-typed names in large tables, on Spark."""

from pyspark import cloudpickle

from namefold.functions import fuzzy, kernels

# Sent to the workers with each job, so executors need no copy of this package.
for _module in (fuzzy, kernels):
    cloudpickle.register_pickle_by_value(_module)
