"""Operators over text collections for training data; nothing outside this subpackage imports it."""
