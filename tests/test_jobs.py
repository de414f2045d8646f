import json

import pytest

from orderlake import jobs
from tests.helpers import dimensions, order
from tests.shapes import box, polygon


def run(capsys, spark, *argv):
    jobs.main(argv, spark)
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_all_jobs(spark, tmp_path, capsys, monkeypatch):
    at = lambda name: str(tmp_path / name)
    employees, customers, _ = dimensions(spark)
    employees.write.parquet(at("employees"))
    customers.write.parquet(at("customers"))
    rows = [(k, f"n{k}", f"c{k}", polygon([box(k, 0, k + 1, 1)])) for k in range(4)]
    spark.createDataFrame(
        rows, "OBJECTID int, NOMBRE string, IDENTIFICACION string, geometry binary"
    ).coalesce(1).write.parquet(at("boundaries"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([order(1), order(2, x=1.5), order(3, x=-9.5)]))
    published = []
    monkeypatch.setattr(jobs, "write_jdbc", lambda df, *args: published.append((df.count(), args)))

    assert run(capsys, spark, "areas", "--boundaries", at("boundaries"), "--out", at("cells"))["levels"] == 1
    run(capsys, spark, "bronze", "--root", at("lake"), "--option", f"path={at('in')}", "--available-now", "--files", "1")
    silver = ["silver", "--root", at("lake"), "--employees", at("employees"), "--customers", at("customers"), "--areas", at("cells")]
    assert run(capsys, spark, *silver)["rows"] == 3
    assert run(capsys, spark, *silver, "--span-hours", "1")["rows"] is None
    gold = ["gold", "--root", at("lake"), "--jdbc-url", "jdbc:x", "--jdbc-option", "user=u"]
    assert run(capsys, spark, *gold)["rows"] == 3
    assert published == [(2, ("jdbc:x", "daily_sales", {"user": "u"}))]
    rejected = spark.read.parquet(at("lake/gold_rejected")).collect()
    assert [r["reject_reason"] for r in rejected] == ["neighborhood, comune"]

    whole = ["pipeline", "--root", at("lake2"), "--option", f"path={at('in')}", *silver[3:], "--default", "2024-01-01"]
    done = run(capsys, spark, *whole)
    assert done["silver"] == {"rows": 3, "slices": 1} and done["gold"]["rows"] == 3
    later = [*whole[:-1], "2999-01-01"]
    later[2] = at("lake3")
    assert run(capsys, spark, *later)["silver"]["rows"] is None


def test_a_failing_job_raises(spark, tmp_path):
    with pytest.raises(Exception):
        jobs.main(["areas", "--boundaries", str(tmp_path / "absent"), "--out", str(tmp_path / "out")], spark)
    with pytest.raises(SystemExit):
        jobs.main(["unknown"], spark)
