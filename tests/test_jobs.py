"""Jobs from configuration to written records."""

import pytest

from millrace.operators import jobs, rollout


def test_configuration():
    c = jobs.JobConfig.of({"source": "parquet", "path": "x", "extra": {"a": 1, "b": {"c": 2}}}, {"system_prompt": "Be kind.", "unknown": 1, "extra": {"b": {"d": 3}}})
    assert c.system_prompt == ["Be kind."] and c.extra == {"a": 1, "b": {"c": 2, "d": 3}}
    for bad in ({"mode": "multi_turn"}, {"count_tokens": True}, {"max_examples": 0}, {"mode": "x"}):
        with pytest.raises(ValueError):
            jobs.JobConfig(source="parquet", path="x", **bad)


def test_states():
    job = jobs.Job(jobs.JobConfig(source="parquet", path="x"))
    assert job.move("running") and job.move("cancelled") and not job.move("completed") and job.state == "cancelled"


@pytest.mark.parametrize("mode, n", [("text", 3), ("tools", 5), ("multi_turn", 5)])
def test_runs(spark, tmp_path, mode, n):
    spark.createDataFrame([(i, f"q{i}" if i != 3 else None, i) for i in range(10)], "id bigint, q string, prompt bigint").write.parquet(f"{tmp_path}/in")
    tools = rollout.ToolRegistry()
    tools.add("f", lambda q: q)
    config = jobs.JobConfig(source="parquet", path=f"{tmp_path}/in", prompt_field="q", max_examples=5, system_prompt=["a", "b"], mode=mode, user_prompt="ask", turns=2, output=f"{tmp_path}/out")
    job = jobs.run_job(spark, config, rollout.StubBackend(), tools)
    assert job.state == "completed" and job.result["records"] == 5
    got = {r.id: len(r.trajectory) for r in spark.read.json(f"{tmp_path}/out").collect()}
    assert got == dict.fromkeys((0, 1, 2, 4, 5), n)


def test_failures_end_in_a_state(spark):
    job = jobs.run_job(spark, jobs.JobConfig(source="nowhere", path="x"), rollout.StubBackend())
    assert job.state == "failed" and job.events[-2]["level"] == "error"
