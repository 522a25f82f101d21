"""Sequential per-group steps, many groups per Python call.

``applyInPandas`` makes one Arrow round trip per group, which dominates when
groups are tiny (a rising run, a burst of events).  Here rows are
hash-partitioned by the group columns and sorted within each partition, and
one ``mapInPandas`` call walks all groups of a partition.  A group cut by an
Arrow batch boundary is carried into the next batch, so ``fn`` always sees
whole groups; memory is bounded by the largest group, as with
``applyInPandas``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def group_bounds(pdf: pd.DataFrame, group_cols: Sequence[str]) -> np.ndarray:
    """Start offsets of each group in a frame sorted by ``group_cols`` (+ end)."""
    n = len(pdf)
    if n == 0:
        return np.array([0], dtype=np.int64)
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for c in group_cols:
        # Codes compare nulls as equal, and large ids without going through floats.
        v = pd.factorize(pdf[c], use_na_sentinel=False)[0]
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), n)


def map_sorted_groups(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                      fn: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], schema: str) -> DataFrame:
    """Apply ``fn(frame, bounds)`` to frames holding whole, sorted groups."""
    gcols = list(group_cols)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []          # pieces of the last group, joined once it has ended
        for pdf in batches:
            if pdf.empty:
                continue
            edge = pd.concat([held[-1].iloc[-1:], pdf], ignore_index=True) if held else pdf
            starts = group_bounds(edge, gcols)[:-1] - len(held[:1])      # places in pdf; -1 is the held group's
            cut = int(starts[-1])
            if cut >= 0 and (cut > 0 or held):
                done = pd.concat([*held, pdf.iloc[:cut]], ignore_index=True)
                if len(done):
                    yield fn(done, group_bounds(done, gcols))
                held = []
            held.append(pdf.iloc[max(cut, 0):])
        if held:
            done = pd.concat(held, ignore_index=True)
            yield fn(done, group_bounds(done, gcols))

    return (df.repartition(*gcols)
              .sortWithinPartitions(*gcols, *order_cols)
              .mapInPandas(run, schema))
