"""Pages that no one can read, as images: each a function of seed, name and source alone."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.pixels import decoded, grown, image_size, png, shrunk

# Ranges of a made page's width and height, of its paper's colours and grain, and of the cells across that are
# left of an obliterated one.
WIDTHS, HEIGHTS, PAPER, GRAIN, CELLS = (320, 1000), (240, 1400), (225, 255), (0.02, 0.08), (10, 20)


def _blank(draw: random.Random, width: int, height: int) -> np.ndarray:
    """Paper of one bright colour with faint grain."""
    paper, grain = np.array([draw.randint(*PAPER) for _ in range(3)]), np.frombuffer(draw.randbytes(width * height), np.uint8).reshape(height, width, 1)
    return (paper + (grain - paper) * draw.uniform(*GRAIN)).round().astype(np.uint8)


def unreadable_png(kind: str, seed: int, name: str, source: bytes | None = None) -> bytes:
    """blank: paper with grain; noise: random greys or colours; obliterated: the source's page as a few cells of colour.

    Blank and noisy pages have sizes of their own; an obliterated one has its source's. Without a source whose pixels can be
    read, an obliterated page is a blank one, of the source's size if that is known.
    """
    draw = random.Random(f"{kind}:{seed}:{name}")
    width, height = draw.randint(*WIDTHS), draw.randint(*HEIGHTS)
    if kind == "noise":
        return png(width, height, draw.randbytes(width * height * draw.choice((1, 3))))
    if kind == "obliterated" and source:
        try:
            page = decoded(source)
        except (ValueError, OSError, zlib.error):
            try:
                width, height = image_size(source, full=False)
            except ValueError:
                pass
        else:
            height, width = page.shape[:2]
            across = min(width, draw.randint(*CELLS))
            return png(width, height, grown(shrunk(page, across, min(height, max(1, round(height * across / width)))), width, height).tobytes())
    return png(width, height, _blank(draw, width, height).tobytes())


def pixels(seed: int) -> Column:
    """A function of (kind, page_id, source image bytes) to PNG bytes."""

    @F.pandas_udf("binary")
    def make(kind: pd.Series, name: pd.Series, source: pd.Series) -> pd.Series:
        return pd.Series([unreadable_png(k, seed, n, s) for k, n, s in zip(kind, name, source, strict=True)])

    return make
