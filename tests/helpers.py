"""Helpers that test modules import (a plain module: two ``conftest`` modules share one name)."""

SF_SMOKE = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
