"""Training-data operators: secrets, language model, near-duplicates, tokenizing,
decontamination, quality rules, sharding, substring dedup, packed token files, chat
rendering, Merkle manifests, tokenizer alignment and language identification.

Nothing else in the library imports this subpackage. Functions that run inside
Python tasks are pickled by value, so executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
