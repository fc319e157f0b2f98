"""Example file validators for :func:`bundleflow.operators.content.register_validator`.

Kept free of other imports so that executors can load them on their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd


def non_empty_no_nul(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A core file 'decodes' when it is non-empty and holds no NUL character."""
    for pdf in batches:
        ok = [t is not None and len(t) > 0 and "\x00" not in t for t in pdf["content"]]
        yield pd.DataFrame({"tx": pdf["bundle"], "rel_path": pdf["rel_path"], "ok": ok})
