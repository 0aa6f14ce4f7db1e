"""Plain helpers of the tests; imported by name, so they stay out of conftest modules."""


def table(df, *order):
    """Collected rows as sorted tuples."""
    out = [tuple(r) for r in df.select(*(order or df.columns)).collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))
