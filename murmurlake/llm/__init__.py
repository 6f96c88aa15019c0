"""Operators for training data of language models. Nothing outside this subpackage imports it."""
