"""Names for columns that pass through tables of any columns, and batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Bytes of text that a task works on together; a longer text is alone.
SLICE_BYTES = 6 << 20


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be new in ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Parts of a batch of texts of about ``limit`` bytes each."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    edges = np.flatnonzero(np.diff(size // limit)) + 1
    for a, b in zip(np.r_[0, edges].tolist(), np.r_[edges, len(texts)].tolist(), strict=True):
        yield texts.slice(a, b - a)
