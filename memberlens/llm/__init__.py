"""Operators of a training-data pipeline: deduplication, scoring, token counts,
mixing and formatting of text corpora.  Nothing else in the library imports
this subpackage."""
