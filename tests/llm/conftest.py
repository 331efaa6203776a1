"""Frames that the operators must take: NULLs, empty and long texts, repeats, clashing names."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ("_blob", "_stats", "_leaks", "blob_id", "spans", "fp", "label", "ids", "score", "row", "component_id")


@pytest.fixture(scope="session")
def docs_of(spark):
    """``docs_of(texts)`` or ``docs_of([(doc_id, text)])``: a documents frame, optionally with clashing columns."""

    def make(rows, clashing=False):
        rows = [(k, r) if not isinstance(r, tuple) else r for k, r in enumerate(rows)]
        schema = DOCS
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        if clashing:
            schema += "".join(f", {c} string" for c in CLASHING)
            full = [r + ("x",) * len(CLASHING) for r in full]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def rows_of():
    def collect(df, key="doc_id"):
        return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: (r[key] is None, r[key]))

    return collect
