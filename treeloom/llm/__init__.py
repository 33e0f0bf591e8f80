"""Operators of a training-data pipeline: quality, duplicates, licences, packing, language-model scores."""
