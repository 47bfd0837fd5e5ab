"""Operators that prepare text for training: language labels, packing, mixing.

Nothing outside this subpackage imports it.
"""
