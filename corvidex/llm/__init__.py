"""Training-data operators: search, filtering, annotation, sharding and packing.

Nothing outside this subpackage imports it.  Each module holds one operator with a
general interface; :mod:`corvidex.llm.queries` holds the thin ``opN_<name>`` queries.
"""
