"""Helpers shared by the test modules."""


def rows(df, *cols):
    """Sorted list of tuples of the chosen columns."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
