"""Operators that prepare training data: sharding, de-duplication, packing, fingerprints, classifiers, fixity, mixing."""
