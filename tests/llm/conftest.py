from __future__ import annotations

import pytest

from tests.conftest import spark  # noqa: F401

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):  # noqa: F811
    """Builds a documents table from ``(doc_id, text)`` or ``(doc_id, text, source)``, with columns whose names clash with the operators' own."""

    def build(rows):
        rows = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, 1, "x", "k") for r in rows]
        return spark.createDataFrame(rows, DOCUMENTS + ", h long, line string, id string")

    return build
