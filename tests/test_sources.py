"""Export scanning, quarantine, flattening and CSV round trips on hand-made files."""

import json

import pytest

from annolytics.sources import exports as X
from annolytics.sources import tables as TB


def task(tid, text, anns, upload="doc_otp.pdf"):
    return {"id": tid, "inner_id": tid, "file_upload": upload, "created_at": "c", "updated_at": "u",
            "data": {"text": text}, "annotations": anns}


def ann(aid, choice, lead=12.5, result=True):
    res = [{"value": {"choices": [choice] if choice is not None else []}}] if result else []
    return {"id": aid, "completed_by": 7, "created_at": "ac", "updated_at": "au", "lead_time": lead, "result": res}


@pytest.fixture(scope="module")
def export_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("exports")
    (root / "AAA").mkdir()
    (root / "BBB").mkdir()
    (root / "Sample").mkdir()
    (root / "BBB" / "nested").mkdir()
    # list file: a normal task, a task without annotations, one with empty text,
    # one annotation without result and one with empty choices
    (root / "AAA" / "list.json").write_text(json.dumps([
        task(1, "first text", [ann(11, "4-Érthető"), ann(12, None), ann(13, "2-x", result=False)]),
        task(2, "no annotations", []),
        task(3, "", [ann(31, "1-x")]),
        task(4, "second text", [ann(41, "x-label", lead=None)]),
    ]), encoding="utf-8")
    # single-object file
    (root / "BBB" / "one.json").write_text(json.dumps(task(5, "bbb text", [ann(51, "5-K")])), encoding="utf-8")
    # truncated file: quarantined, contributes no rows
    (root / "BBB" / "broken.json").write_text('[{"id": 6, "data": {"text": "cut', encoding="utf-8")
    # excluded folder and a nested file (not read: the scan is one level deep)
    (root / "Sample" / "s.json").write_text(json.dumps([task(7, "sample", [ann(71, "3-x")])]), encoding="utf-8")
    (root / "BBB" / "nested" / "deep.json").write_text(json.dumps([task(8, "deep", [ann(81, "3-x")])]), encoding="utf-8")
    return str(root)


def test_scan_flatten(spark, export_root):
    rows, bad = X.read_exports(spark, export_root)
    got = sorted((r.student_code, r.json_filename, r.annotation_id, r.label_text, r.label_numeric, r.lead_time_seconds)
                 for r in rows.collect())
    assert got == [
        ("AAA", "list.json", 11, "4-Érthető", 4, 12.5),
        ("AAA", "list.json", 41, "x-label", None, None),
        ("BBB", "one.json", 51, "5-K", 5, 12.5),
    ]
    assert [(r.student_code, r.json_filename) for r in bad.collect()] == [("BBB", "broken.json")]


def test_flatten_keeps_file_order(spark, export_root):
    rows, _ = X.read_exports(spark, export_root)
    a = [r.task_id for r in rows.filter("student_code = 'AAA'").orderBy("task_pos", "annotation_pos").collect()]
    assert a == [1, 4]


def test_ingest_summary(spark, export_root):
    rows, _ = X.read_exports(spark, export_root)
    got = {(r.metric, r.label): r.value for r in X.ingest_summary(rows).collect()}
    assert got[("total_records", None)] == 3
    assert got[("unique_annotators", None)] == 2
    assert got[("unique_texts", None)] == 3
    assert got[("label_count", 4)] == 1 and got[("label_count", 5)] == 1
    assert not any(k == ("label_count", None) for k in got)


def test_csv_round_trip(spark, tmp_path):
    data = [("A", 'He said "hi", then\nleft', 1, 2.5), ("B", "", None, None), ("C", "plain", 3, 0.1)]
    schema = "student_code string, text string, label_numeric int, lead_time_seconds double"
    df = spark.createDataFrame(data, schema)
    path = str(tmp_path / "csv")
    assert TB.write_annotations_csv(df, path)
    back = sorted(tuple(r) for r in TB.read_annotations_csv(spark, path, schema=df.schema).collect())
    assert back[0] == ("A", 'He said "hi", then\nleft', 1, 2.5)
    assert back[2] == ("C", "plain", 3, 0.1)
    assert back[1][0] == "B" and back[1][2] is None and back[1][3] is None


def test_csv_empty_writes_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "a string")
    assert TB.write_annotations_csv(df, str(tmp_path / "none")) is False
    assert not (tmp_path / "none").exists()


def test_streaming_ingest_is_incremental(spark, tmp_path):
    from annolytics.streaming.ingest import ingest_new_exports

    root = tmp_path / "landing"
    (root / "AAA").mkdir(parents=True)
    (root / "AAA" / "a.json").write_text(json.dumps([task(1, "one", [ann(11, "3-x")])]), encoding="utf-8")
    out = str(tmp_path / "table")
    ingest_new_exports(spark, str(root), out)  # the default checkpoint
    assert spark.read.parquet(out).count() == 1
    (root / "AAA" / "b.json").write_text(json.dumps(task(2, "two", [ann(21, "4-x"), ann(22, "5-x")])), encoding="utf-8")
    ingest_new_exports(spark, str(root), out)
    got = sorted(r.annotation_id for r in spark.read.parquet(out).collect())
    assert got == [11, 21, 22]


def test_mistyped_fields_cost_only_themselves(spark, tmp_path):
    (tmp_path / "AAA").mkdir()
    good, odd = task(1, "one", [ann(11, "3-x")]), task(2, "two", [ann(21, "4-x")])
    odd["id"] = "two"
    odd["annotations"][0]["completed_by"] = {"id": 7, "email": "x"}
    odd["annotations"][0]["lead_time"] = "fast"
    (tmp_path / "AAA" / "a.json").write_text(json.dumps([good, odd]), encoding="utf-8")
    (tmp_path / "AAA" / "b.json").write_text('[{"id": 3, "data"', encoding="utf-8")
    rows, bad = X.read_exports(spark, str(tmp_path))
    got = {r.annotation_id: r for r in rows.collect()}
    assert set(got) == {11, 21}
    assert got[21].task_id is None and got[21].completed_by == 7 and got[21].lead_time_seconds is None
    assert [r.json_filename for r in bad.collect()] == ["b.json"]


def test_excluded_folders_are_not_read(spark, tmp_path):
    for name in ("AAA", "Sample"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text(json.dumps([task(1, "one", [ann(11, "3-x")])]), encoding="utf-8")
    t = X.scan_exports(spark, str(tmp_path))
    assert [r.student_code for r in t.select("student_code", "id").collect()] == ["AAA"]


def test_scratch_folder_stays_put(spark):
    from annolytics.session import ensure_checkpoint_dir

    assert len({ensure_checkpoint_dir(spark) for _ in range(50)}) == 1


# --- large files by byte ranges ------------------------------------------------------


def tricky_tasks(n):
    texts = ['plain {text} [1]', 'quote " and \\ back\\\\slash', 'é漢 }{ ]', '\\"}', "", "x" * 300, "line\nbreak "]
    return [
        {"id": i, "data": {"text": f"{i} {texts[i % len(texts)]}"}, "file_upload": "f}.csv", "annotations": [{"id": 10 * i, "lead_time": i / 2, "result": [{"value": {"choices": ["3-x"]}}]}]}
        for i in range(n)
    ]


def test_large_files_by_ranges_equal_the_whole_file_reader(spark, tmp_path):
    import json

    tasks = tricky_tasks(400)
    for name, dump in (("compact", json.dumps(tasks)), ("pretty", json.dumps(tasks, indent=2, ensure_ascii=False)), ("one", " \n" + json.dumps(tasks[0])), ("none", "[ ]\n")):
        (tmp_path / "root" / name).mkdir(parents=True)
        (tmp_path / "root" / name / "a b+c.json").write_text(dump, encoding="utf-8")
    (tmp_path / "root" / "sample").mkdir()
    (tmp_path / "root" / "sample" / "x.json").write_text(json.dumps(tasks))
    root = str(tmp_path / "root")

    def rows(df):
        got = df.orderBy("student_code", "task_pos").collect()
        return [(r.student_code, r.json_filename, r.id, r.data.text, r.file_upload, r.annotations[0].lead_time) for r in got]

    whole = rows(X.scan_exports(spark, root))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        ranged = X.scan_exports(spark, root, large_bytes=1)
        from annolytics.sources import json_ranges as J

        assert J._pieces(spark, f"{root}/*/*.json", 1, root).select("path", "block").distinct().count() > 10
        assert rows(ranged) == whole and len(whole) == 801
        mixed = X.scan_exports(spark, root, large_bytes=(tmp_path / "root" / "pretty" / "a b+c.json").stat().st_size)
        assert rows(mixed) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_broken_large_files_are_quarantined(spark, tmp_path):
    import json

    good = json.dumps(tricky_tasks(30))
    broken = {
        "cut": good[: len(good) // 2],
        "cut_after_record": good[: good.rindex("}") + 1],
        "no_comma": good.replace("}, {", "} {", 1) if "}, {" in good else good,
        "trailing": good + ", {}",
        "bad_record": good.replace('"id": 20,', '"id": 20 x,', 1),
        "two": json.dumps({"id": 1}) + json.dumps({"id": 2}),
    }
    for name, text in {**broken, "fine": good}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.json").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        tasks, bad = X.quarantine_bad_files(X.scan_exports(spark, str(tmp_path), large_bytes=1))
        assert {r.student_code for r in bad.collect()} == set(broken)
        assert [r.student_code for r in tasks.select("student_code").distinct().collect()] == ["fine"]
        assert tasks.count() == 30
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# --- unreadable files in the incremental ingest -------------------------------------------


def test_streaming_lists_unreadable_files_once(spark, tmp_path, monkeypatch):
    from annolytics.streaming import ingest as I

    root, out = tmp_path / "landing", str(tmp_path / "table")
    (root / "AAA").mkdir(parents=True)
    (root / "AAA" / "a.json").write_text(json.dumps([task(1, "one", [ann(11, "3-x")])]), encoding="utf-8")
    (root / "AAA" / "bad.json").write_text('[{"id": 3, "data"', encoding="utf-8")
    write = I._write
    written = []

    def lost_between(df, path):
        if "_unreadable" in path and not written:
            written.append(path)
            raise RuntimeError("lost between the two writes")
        write(df, path)

    monkeypatch.setattr(I, "_write", lost_between)
    with pytest.raises(Exception, match="lost between"):
        I.ingest_new_exports(spark, str(root), out)
    I.ingest_new_exports(spark, str(root), out)  # the batch is replayed
    (root / "AAA" / "b.json").write_text(json.dumps(task(2, "two", [ann(21, "4-x")])), encoding="utf-8")
    (root / "AAA" / "worse.json").write_text("nothing", encoding="utf-8")
    I.ingest_new_exports(spark, str(root), out)
    assert sorted(r.annotation_id for r in spark.read.parquet(out).collect()) == [11, 21]
    bad = I.unreadable_files(spark, out).collect()
    assert sorted((r.student_code, r.json_filename) for r in bad) == [("AAA", "bad.json"), ("AAA", "worse.json")]
