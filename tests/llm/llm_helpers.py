"""Rows of results in an order of their own."""


def ordered(rows):
    """Sorted rows; NULL comes first."""
    return sorted(map(tuple, rows), key=lambda r: [(v is not None, v) for v in r])


def rows_of(df, *columns):
    return ordered(df.select(*columns).collect())
