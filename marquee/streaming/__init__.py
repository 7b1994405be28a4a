"""Structured Streaming entry points.

The reference is a batch system (no watermarks, windows or state).  The one
streaming-shaped need is new catalogue items: they must be usable by the
similarity recommenders without a refit.  ``catalog_stream`` reads new item
files as a stream and appends their TF-IDF weights under the stored
vocabulary.
"""

from .catalog_stream import start_item_vectoriser, vectorise_batch

__all__ = ["start_item_vectoriser", "vectorise_batch"]
