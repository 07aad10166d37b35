import pytest

from vialume import session


class FakeConf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)

    def set(self, key, value):
        self[key] = value


class FakeSpark:
    def __init__(self, **conf):
        self.conf = FakeConf(conf)


def test_the_cluster_names_the_shared_folder():
    spark = FakeSpark(**{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.shared_dir(spark) == "hdfs:///shared"
    assert session.scratch_path(spark, "x").startswith("hdfs:///shared/vialume-x-")


def test_a_local_folder_is_made_once_where_none_is_named():
    spark = FakeSpark()
    assert session.shared_dir(spark) == session.shared_dir(spark)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSpark(**{"spark.master": master}))
