"""Operators for text corpora: markup, truncation, packing, mixing and residue.  Nothing else in the library imports this."""
