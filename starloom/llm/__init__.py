"""Operators of a training-data pipeline on the documents, pages, benchmark, labels and
conversations tables. Nothing else in the library imports this subpackage."""
