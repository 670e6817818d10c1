"""Operators that prepare training text: filtering, de-duplication, mixing, packing and sharding of documents."""
