"""Where steps of a job are written."""

from fathomline import session


def test_the_cluster_names_the_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return "hdfs:///shared/steps/" if key == "spark.checkpoint.dir" else default

    class Fake:
        conf = Conf()
        sparkContext = spark.sparkContext

    assert session.shared_dir(Fake()) == "hdfs:///shared/steps"
    assert session.scratch_path(Fake(), "x").startswith("hdfs:///shared/steps/x-")


def test_a_written_step_starts_a_new_plan(spark):
    df = spark.range(10).selectExpr("id", "id % 3 as k").groupBy("k").count()
    cut = session.cut_lineage(df)
    assert sorted(cut.collect()) == sorted(df.collect()) and cut.schema.names == df.schema.names
    assert "Aggregate" not in cut._jdf.queryExecution().optimizedPlan().toString()
    assert session.shared_dir(spark) == session.shared_dir(spark)
