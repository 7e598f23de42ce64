from __future__ import annotations

import pytest

from roadbook.llm.common import table

TINY = "/root/testdata/sf0.001"

# nulls, empty and very long texts, ties and repeated rows
TEXTS = [None, "", " ", "one", "one", "the same words again", "the same words again", "  two  spaces ", "tab\tand\nline x",
         "é漢字\x00😀 mixed", "▁odd▁ mark", "word " * 30_000, "x" * 20_000]


@pytest.fixture
def strange(spark):
    """Documents with every strange text, repeated rows, a null id and extra columns with clashing names."""
    rows = [(i, t, "s%d" % (i % 3) if i % 4 else None, i, "k", "r") for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "no id", "s1", 1, "k", "r")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size long, key string, id string")


@pytest.fixture(scope="session")
def documents(spark):
    return table(spark, TINY, "documents")


def by_id(rows, key="doc_id"):
    return {r[key]: r for r in rows}
