"""Operators for training data: packing, mixing and truncation. Nothing outside this subpackage imports it."""
