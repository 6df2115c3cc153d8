"""Training-data operators: rules, deduplication, decontamination, mixing, sharding, packing.

Nothing outside this subpackage imports it.
"""
