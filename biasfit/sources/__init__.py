"""Readers: '::'-delimited rating/item text files and the driver's testdata tables."""

from biasfit.sources.text import read_ratings_text, read_items_text, write_ratings_text, write_items_text
from biasfit.sources.testdata import TestdataViews

__all__ = ["read_ratings_text", "read_items_text", "write_ratings_text",
           "write_items_text", "TestdataViews"]
