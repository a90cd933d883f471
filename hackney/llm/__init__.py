"""Training-data operators: sharding, tokenizers, search, packing, extraction, dedup, language ID.

Nothing outside this package imports it; the queries over the driver's tables
are in ``registry`` and are added to ``__spark_entry__`` only when this package
is present.
"""
