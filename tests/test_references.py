"""References in the place of texts, hash filters, export files and patterns."""

import glob
import random

from pyspark.sql import functions as F

from annolytics.functions import text as T
from annolytics.functions.stats import hash_filter
from annolytics.operators import clean as C
from annolytics.operators import profile as P
from annolytics.sources import exports as X
from annolytics.sources import tables as TB

COLUMNS = "annotation_id long, student_code string, source_file string, text string, label_text string, label_numeric int, annotation_created_at string, lead_time_seconds double"


def annotations(spark, n=400):
    r = random.Random(5)
    texts = [None, "", *["word " * r.randint(1, 40) + str(i) for i in range(60)]]
    rows = []
    for i in range(n):
        label = r.choice([None, 1, 2, 3, 4, 5])
        rows.append((i, r.choice(["A", "B", "C", None]), r.choice(["s1", "s2", None]), r.choice(texts), f"{label}-x", label, "2024-01-01 00:00:00.000000", r.choice([None, 1.0, r.random() * 100])))
    return spark.createDataFrame(rows, COLUMNS)


def test_cleaning_by_reference_chooses_the_same_rows(spark):
    df = annotations(spark)
    refs = df.withColumn("text", C.text_reference())
    plain, narrow = (C.clean(x, (("B", "s1"),), min_mean_lead=20.0) for x in (df, refs))
    texts = df.select("text")
    for name in ("test", "deduped", "long_enough", "train"):
        want, got = getattr(plain, name), C.attach_texts(getattr(narrow, name), texts)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert P.dataset_stats(narrow.test).collect() == P.dataset_stats(plain.test).collect()
    assert P.dataset_overview(refs).collect() == P.dataset_overview(df).collect()


def test_registered_cleaning_moves_no_text(spark, sf_dir):
    from annolytics.plans.cleaning import cleaned

    c = cleaned(spark, sf_dir)
    assert all(C.is_reference(x) for x in (c.raw, c.test, c.deduped, c.train))


def test_hash_filter_keeps_all_keys_and_few_others(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("name"))
    keys = df.filter("id % 10 = 3")
    got = {r["id"] for r in hash_filter(df, keys, ["id", "name"]).collect()}
    want = {r["id"] for r in keys.collect()}
    assert want <= got and len(got - want) < 18_000 / 8
    assert hash_filter(df, keys.limit(0), ["id"]).count() == 0


def test_export_files_are_cut_without_a_shuffle(spark, tmp_path):
    df = annotations(spark).filter("student_code is not null and text <> ''").repartition(3)
    rows = {}
    for compression, ending in (("none", "txt"), ("gzip", "txt.gz")):
        root = str(tmp_path / compression)
        X.write_exports(df, root, tasks_per_file=10, compression=compression)
        assert len(glob.glob(f"{root}/*/*.{ending}")) >= df.count() / 10
        tasks, bad = X.quarantine_bad_files(X.scan_exports(spark, root, pattern=f"*.{ending}"))
        assert bad.count() == 0
        assert tasks.groupBy("_file_path").count().agg(F.max("count")).first()[0] <= 10
        rows[ending] = sorted((r["annotation_id"], r["student_code"], r["text"]) for r in X.flatten_annotations(tasks).collect())
    want = sorted((r["annotation_id"], r["student_code"], r["text"]) for r in df.collect())
    assert rows["txt"] == rows["txt.gz"] == want
    assert "spark.sql.maxConcurrentOutputFileWriters" not in spark.conf.getAll or spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_long_exports_are_passed_on_in_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(X, "FILE_CHARS", 50)
    monkeypatch.setattr(X, "HELD_CHARS", 90)
    codes, tasks = [str(i % 4) for i in range(40)], ['"%s"' % ("x" * (i % 13)) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(codes), pa.array(tasks)], names=["student_code", "t"])
    files = [(f["student_code"][0].as_py(), f["value"][0].as_py()) for f in X._export_files(1000)(iter([batch]))]
    assert len(files) > 8 and max(len(v) for _, v in files) < 80
    for code in "0123":
        got = ",".join(v[1:-1] for c, v in files if c == code)
        assert got == ",".join(t for c, t in zip(codes, tasks) if c == code)


def test_compressed_csv_round_trip(spark, tmp_path):
    df = annotations(spark).withColumn("text", F.concat("text", F.lit('"\n,x')))
    assert TB.write_annotations_csv(df, str(tmp_path / "c"), compression="gzip")
    assert glob.glob(str(tmp_path / "c" / "*.csv.gz"))
    back = TB.read_annotations_csv(spark, str(tmp_path / "c"), schema=df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_patterns_equal_the_plain_ones(spark):
    r = random.Random(3)
    parts = ["ség", "ben", "ig", "ért", "fenti", "jelen", "3. pont", "12. §", "7.", "a) ", "b)\t", "x", "_", "é", "Ő", " ", " ", "\n", "!", ".", "~", "\x1c", "٣. ", "\U0001f600"]
    df = spark.createDataFrame([("".join(r.choices(parts, k=r.randint(0, 30))),) for _ in range(600)], "t string")
    before, after, ws = T.NOT_WORD_BEFORE, T.NOT_WORD_AFTER, T.WS
    plain = {
        T.TOKEN: f"[^{ws}]+",
        T.NUMBERING: f"{before}\\p{{Nd}}+\\.[{ws}]|{before}[a-z]\\)[{ws}]",
        T.suffix_pattern(): f"(?:{'|'.join(T.LEGAL_SUFFIXES)}){after}",
        T.reference_pattern(): f"{'|'.join(T.REFERENCE_WORDS)}|\\p{{Nd}}+\\.[{ws}]*(?:{'|'.join(T.REFERENCE_UNITS)})",
        T.reference_pattern(()): f"\\p{{Nd}}+\\.[{ws}]*(?:{'|'.join(T.REFERENCE_UNITS)})",
        T.suffix_pattern(()): "(?!)",
    }
    found = [F.regexp_extract_all("t", F.lit(p), 0) for pair in plain.items() for p in pair]
    for row in df.select(*[f.alias(f"c{i}") for i, f in enumerate(found)]).collect():
        assert row[0::2] == row[1::2]
    assert df.filter(F.regexp_count("t", F.lit(T.suffix_pattern())) > 0).count() > 100


def test_copies_of_a_text_lie_together_in_a_compressed_csv(spark, tmp_path):
    import os
    import random

    r = random.Random(1)
    texts = ["a" + "".join(r.choice("abcdefghijklmnop \n\",") for _ in range(2_000)) + "z" for _ in range(60)] + [None]
    rows = [(i, texts[i % 61]) for i in range(61 * 20)]
    df = spark.createDataFrame(rows, "annotation_id long, text string").repartition(8, "annotation_id")

    def size(path):
        return sum(os.path.getsize(f) for f in glob.glob(f"{path}/*.csv.gz"))

    plain, together = str(tmp_path / "plain"), str(tmp_path / "together")
    assert TB.write_annotations_csv(df, plain, compression="gzip")
    assert TB.write_annotations_csv(df, together, compression="gzip", together=C.text_digest(df), files=3)
    assert size(together) * 4 < size(plain)
    back = TB.read_annotations_csv(spark, together, schema=df.schema)
    assert back.columns == df.columns and {tuple(x) for x in back.collect()} == set(rows) and back.count() == len(rows)
    assert not TB.write_annotations_csv(df.limit(0), str(tmp_path / "none"), together=C.text_digest(df))


def test_ingest_job_writes_copies_together_and_lands_quick_files(spark, sf_dir, monkeypatch):
    from annolytics.plans import ingest as I

    seen, landed = [], []
    write, exports = I.TB.write_annotations_csv, I.X.write_exports

    def csv(df, path, **options):
        seen.append(options)
        return write(df, path, **options)

    def land(df, root, **options):
        out = exports(df, root, **options)
        landed.append((len(glob.glob(f"{root}/*/*.lz4")), len(glob.glob(f"{root}/*/part-*"))))
        return out

    monkeypatch.setattr(I.TB, "write_annotations_csv", csv)
    monkeypatch.setattr(I.X, "write_exports", land)
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert I.q_ingest_job(spark, sf_dir).filter("part = 'record'").count() == n
    assert len(seen) == 1 and len(seen[0]["together"]) == 2
    assert I.q_exclude_folders(spark, sf_dir).count() > 0
    assert all(quick == files > 0 for quick, files in landed) and len(landed) == 2


def test_written_exports_and_csv_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    from annolytics import session
    from annolytics.sources import exports as X

    during = []
    inner = session.shuffles_deleted

    def watched(s):
        during.append(True)
        return inner(s)

    monkeypatch.setattr(X, "shuffles_deleted", watched)
    monkeypatch.setattr(TB, "shuffles_deleted", watched)
    before = spark.conf.get(session._CLEANUP, "false")
    a = spark.createDataFrame([(1, "U01", "s", "t", "1-x", 1, "2020", 1.0)], "annotation_id long, student_code string, source_file string, text string, label_text string, label_numeric int, annotation_created_at string, lead_time_seconds double")
    X.write_exports(a, str(tmp_path / "x"), compression="lz4")
    TB.write_annotations_csv(a, str(tmp_path / "c"))
    with inner(spark):
        assert spark.conf.get(session._CLEANUP) == "true"
    assert len(during) == 2 and spark.conf.get(session._CLEANUP, "false") == before
