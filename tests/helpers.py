"""Small helpers for the tests."""

import contextlib
import io


def rows(df, *columns):
    """Rows as a sorted list of tuples; nulls first."""
    df = df.select(*columns) if columns else df
    return sorted(map(tuple, df.collect()), key=lambda r: [(v is not None, v) for v in r])


def final_plan(df):
    """The physical plan as it was run, as text."""
    df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue().split("== Initial Plan ==")[0]


def plan(df):
    """The physical plan before execution, as text."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.select("*").explain()  # a new plan, so nothing of it has run yet
    return text.getvalue()
