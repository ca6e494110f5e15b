"""Training-data operators: filtering, deduplication, mixing, packing, sharding.

One module per operator, each with its own general interface, and
``queries`` with the registered ``opN_<name>`` queries and their SQL. Nothing
outside this subpackage imports it except ``__spark_entry__`` (guarded) and
``corpus_pipeline``.
"""
