"""Operators for training data: residue, term counts, near duplicates, quality, look-alikes, copies, sentences,
packing, mixing and reading level. Nothing outside this subpackage imports it."""
