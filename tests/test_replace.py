import pytest
from pyspark.sql import functions as F

from riskframe.sources import recover_table, replace, replace_table, write_table

STEPS = ["write", "touch", "move 1", "move 2", "delete old", "delete swap", None]


class Ended(Exception):
    pass


def fail_at(monkeypatch, step):
    """End the job when it reaches a step."""
    moves = []

    def watched(name, real):
        def call(self, *paths):
            moves.append(name) if name == "move" else None
            reached = {"touch": "touch", "move": f"move {len(moves)}",
                       "delete": {"old": "delete old", "swap": "delete swap"}.get(paths[0].rsplit(".", 1)[-1])}[name]
            if step and reached == step:
                raise Ended(step)
            return real(self, *paths)
        return call
    for name in ("touch", "move", "delete"):
        monkeypatch.setattr(replace.Folders, name, watched(name, getattr(replace.Folders, name)))


@pytest.mark.parametrize("step", STEPS)
def test_an_ended_job_leaves_one_whole_table(spark, tmp_path, monkeypatch, step):
    path = write_table(spark.range(100).withColumn("v", F.lit(1)), str(tmp_path / "t"))
    old = spark.read.parquet(path)
    new = old.where("id % 2 = 0").withColumn("v", F.lit(2))
    if step == "write":
        new = new.withColumn("v", F.raise_error(F.lit("lost")))
    with monkeypatch.context() as patched:
        fail_at(patched, step)
        if step is None:
            assert replace_table(new, path) == path
        else:
            with pytest.raises(Exception):
                replace_table(new, path)
    unfinished = step in ("move 1", "move 2", "delete old", "delete swap")
    assert recover_table(spark, path) == unfinished and not recover_table(spark, path)
    got = sorted(map(tuple, spark.read.parquet(path).collect()))
    replaced = step not in ("write", "touch")
    assert got == ([(i, 2) for i in range(0, 100, 2)] if replaced else [(i, 1) for i in range(100)])
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    again = replace_table(spark.read.parquet(path).withColumn("v", F.lit(3)), path)
    assert spark.read.parquet(again).where("v = 3").count() == len(got)


def test_a_new_path(spark, tmp_path):
    path = str(tmp_path / "fresh")
    assert spark.read.csv(replace_table(spark.range(3), path + "/", "csv"), header=True).count() == 3
