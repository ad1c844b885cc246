"""What several test modules use. Not in conftest.py: every folder of tests has one of that name."""


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)
