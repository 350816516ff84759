"""Operators of a training-data pipeline. Nothing outside this package imports it."""

from pyspark import cloudpickle

from namefold.llm import alignment, bitslice, divergence, multiset, quality, simhash, substring, token_orc, toxicity, urls, words

# Sent to the workers with each job, so executors need no copy of this package.
for _module in (alignment, bitslice, divergence, multiset, quality, simhash, substring, token_orc, toxicity, urls, words):
    cloudpickle.register_pickle_by_value(_module)
