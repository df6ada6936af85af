import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Frames of the documents table's columns, plus columns whose names
    operators use themselves."""

    def make(rows, extra=True):
        full = [(i, t, lang, src, len(t) if t is not None else None) for i, t, lang, src in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        if extra:
            names = "kept size id digest n component_id _p _source _target _id _row _pii_doc_id mix_size toxic row".split()
            schema += "".join(f", {c} string" for c in names) + ", tags map<string,int>"
            full = [(*r, *(f"own {c}" for c in names), {"a": 1}) for r in full]
        return spark.createDataFrame(full, schema)

    return make
