"""Operators for training-data pipelines. Nothing else in the library imports
this subpackage; import the operator modules directly (this file imports none)."""
