import os

import pytest

from annolytics.plans import training as P
from annolytics.stages import Stages


def folders(spark):
    from annolytics.session import ensure_checkpoint_dir

    jobs = f"{ensure_checkpoint_dir(spark)}/jobs"
    return sorted(os.listdir(jobs)) if os.path.isdir(jobs) else []


def test_finished_stages_are_read_again(spark, sf_dir):
    built = []

    def run(fail, param=1):
        with Stages(spark, "demo", [f"{sf_dir}/region.parquet"], {"p": param}) as stages:
            a = stages.table("a", lambda: built.append("a") or spark.range(5))
            b = stages.table("b", lambda: built.append("b") or a.filter("id > 1"))
            if fail:
                raise RuntimeError("lost")
            return stages.result(b, "demo")

    with pytest.raises(RuntimeError):
        run(True)
    assert built == ["a", "b"] and any(f.startswith("demo-") for f in folders(spark))
    assert run(False).count() == 3 and built == ["a", "b"]
    assert not any(f.startswith("demo-") for f in folders(spark))
    run(False, param=2)
    assert built == ["a", "b"] * 2


def test_a_second_clean_job_resumes(spark, sf_dir, monkeypatch):
    calls = []
    resolve = P.C.resolve_duplicates
    monkeypatch.setattr(P.C, "resolve_duplicates", lambda df: calls.append(1) or resolve(df))
    funnel = P.C.cleaning_funnel

    def lost(_):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(P.C, "cleaning_funnel", lost)
    with pytest.raises(RuntimeError):
        P.q_clean_job(spark, sf_dir)
    assert calls == [1] and any(f.startswith("clean-") for f in folders(spark))
    monkeypatch.setattr(P.C, "cleaning_funnel", funnel)
    rows = P.q_clean_job(spark, sf_dir).collect()
    assert calls == [1] and len(rows) == 9
    assert not any(f.startswith("clean-") for f in folders(spark))
