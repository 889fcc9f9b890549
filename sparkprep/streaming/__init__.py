"""Streaming use of fitted transforms.

The reference has no streaming operator. What carries over is that fitted
statistics are plain literals: the imputation/normalisation projection
(``apply_normalization``) and nearest-centroid scoring are stateless column
expressions, so the same functions run unchanged on a ``readStream`` frame.
"""

from sparkprep.streaming.apply import normalize_stream

__all__ = ["normalize_stream"]
