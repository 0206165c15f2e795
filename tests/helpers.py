def rows(df, *columns):
    """Rows as tuples in a stable order."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
