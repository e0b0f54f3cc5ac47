"""Operators for preparing training data: filtering, de-duplication, search, mixing, packing, archiving."""
