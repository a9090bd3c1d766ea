"""128-bit difference hashes of grey images: which of two neighbours in a 9 x 9 picture is
brighter, along rows and along columns. Decoding image files is left to the caller."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIDE, REACH = 9, 3
# Differences below this are rounding, not brightness.
EQUAL = 1e-6


def _weights(size: int) -> np.ndarray:
    """(SIDE, size): a Lanczos kernel for each target place, widened when the picture shrinks."""
    scale = size / SIDE
    wide = max(1.0, scale)
    centre = (np.arange(SIDE) + 0.5) * scale
    x = (np.arange(size)[None, :] + 0.5 - centre[:, None]) / wide
    w = np.where(np.abs(x) < REACH, np.sinc(x) * np.sinc(x / REACH), 0.0)
    return w / w.sum(1, keepdims=True)


def difference_hash(grey: np.ndarray) -> str:
    small = _weights(grey.shape[0]) @ grey.astype(float) @ _weights(grey.shape[1]).T
    rows = (small[: SIDE - 1, 1:] > small[: SIDE - 1, :-1] + EQUAL).ravel()
    cols = (small[1:, : SIDE - 1] > small[:-1, : SIDE - 1] + EQUAL).ravel()
    bits = "".join("1" if b else "0" for b in np.concatenate([rows, cols]))
    return f"dhash128-v1:{int(bits, 2):032x}"


@F.pandas_udf(T.StringType())
def grey_hash(pixels: pd.Series, width: pd.Series) -> pd.Series:
    """The hash of raw grey bytes in rows of ``width``; NULL for none or for a broken size."""

    def one(p: bytes | None, w: float) -> str | None:
        if p is None or w is None or math.isnan(w) or w <= 0 or not len(p) or len(p) % int(w):
            return None
        return difference_hash(np.frombuffer(bytes(p), np.uint8).reshape(-1, int(w)))

    return pd.Series([one(p, w) for p, w in zip(pixels, width, strict=True)])
