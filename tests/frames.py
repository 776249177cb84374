"""Comparing DataFrames in tests. The name is its own: each test folder has a conftest."""


def rows(df, *cols):
    """Sorted list of tuples, for order-insensitive comparison."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is not None, x) for x in t))
