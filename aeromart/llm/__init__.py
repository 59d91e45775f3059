"""Operators for training-data pipelines. Import the modules by name; nothing else in the library does."""
