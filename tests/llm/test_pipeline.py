import json
import os
import re
import subprocess
import sys

import corpus_pipeline as P
from annolytics.llm.queries import QUERIES, SQL, table

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_keep_the_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in P.STAGES[:-1]:
        docs = P.materialize(stage(spark, docs, sf_dir), "t")
        assert docs.columns == columns, name
        if name in ("toxicity", "near_duplicates"):
            assert 0.5 * before < docs.count() <= before
    last = P.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count() and last.filter("NOT exact OR n_tokens <> size(ids)").count() == 0


def test_stages_on_odd_rows(spark, sf_dir, docs_of):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, text + " 9.8.7.6", "en", "s"), (3, text + " 9.8.7.6", "en", "s"), (4, text + " end", "en", "t"), (None, text, "en", "t")]
    docs = docs_of(rows)
    for _, stage in P.STAGES[:-1]:
        docs = P.materialize(stage(spark, docs, sf_dir), "t")
    got = docs.collect()
    assert not any(r["text"] and "9.8.7.6" in r["text"] for r in got)
    assert 4 not in {r["doc_id"] for r in got}
    empty = docs_of([])
    for _, stage in P.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_one_id_with_different_texts(spark, sf_dir, docs_of):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a, "en", "s"), (3, a + " end", "en", "s"), (3, b, "en", "t"), (3, b, "de", "t"), (3, b, "en", "s"), (3, c, "en", "s"), (5, c + " end", "en", "s"), (None, a, "en", "s"), (7, None, "en", "s"), (7, None, "en", "s")]
    for some in (rows, rows[::-1]):
        got = P.drop_near_duplicates(spark, docs_of(some), sf_dir)
        assert got.columns == docs_of(some).columns
        left = sorted(((r["doc_id"], r["text"], r["lang"], r["source"]) for r in got.collect()), key=str)
        assert left == sorted([(1, a, "en", "s"), (3, b, "de", "t"), (3, c, "en", "s"), (None, a, "en", "s"), (7, None, "en", "s")], key=str)


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


def test_nothing_else_needs_the_subpackage():
    code = """
import json, sys
class No:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("annolytics.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, No())
import __spark_entry__ as e
print(json.dumps(sorted(k for k in e.queries() if k.startswith("op") or k == "pipeline")))
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert json.loads(out.stdout.strip().splitlines()[-1]) == [], out.stderr


def test_columns_of_any_name_come_back_unchanged(spark, sf_dir, docs_of):
    text = " ".join(f"w{i}" for i in range(60))
    docs = docs_of([(1, text, "en", "s"), (2, text + " a@example.org", "en", "s"), (5, "other words " * 30, "en", "t"), (7, None, None, None)])
    extra = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    assert {"_p", "_source", "_id", "_row", "_pii_doc_id", "mix_size", "kept", "toxic", "tags"} <= set(extra)
    for _, stage in P.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns and got.count() > 0
        assert {tuple(str(r[c]) for c in extra) for r in got.collect()} == {tuple(str(r[c]) for c in extra) for r in docs.collect()}
