"""Operators of a training-data pipeline: language-model scoring, WARC,
decontamination, licence scans, deduplication, language identification, chat
formatting and packing. Nothing else in the package imports this subpackage."""
