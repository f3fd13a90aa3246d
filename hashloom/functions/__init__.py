"""Column functions: unsigned 64-bit values, digests, names, MurmurHash3."""
