from __future__ import annotations

import itertools
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_data import DOCUMENTS  # noqa: E402


@pytest.fixture()
def make(spark):
    """Documents from texts, or from (doc_id, text, lang, source) rows."""

    def build(rows):
        full = [(k, r, "en", f"s{k % 3}") if r is None or isinstance(r, str) else r for k, r in enumerate(rows)]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCUMENTS)

    return build


@pytest.fixture()
def stored(make, tmp_path):
    """A directory that holds the rows as the documents table."""
    count = itertools.count()

    def build(rows):
        folder = tmp_path / f"sf{next(count)}"
        make(rows).write.parquet(str(folder / "documents.parquet"))
        return str(folder)

    return build
