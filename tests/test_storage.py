"""Where intermediates go."""

from __future__ import annotations

import pytest

from caselens import storage


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Fake:
    def __init__(self, conf, master="local[2]", checkpoint=None):
        self.conf = Conf(conf)
        self.sparkContext = type("C", (), {"master": master, "getCheckpointDir": lambda _: checkpoint})()


def test_a_named_folder_is_taken_at_its_word():
    named = {"spark.checkpoint.dir": "file:///mnt/shared/", "spark.sql.warehouse.dir": "/w"}
    assert storage.shared_root(Fake(named, "spark://host:7077")) == "file:///mnt/shared"
    assert storage.shared_root(Fake({"spark.sql.warehouse.dir": "/w"}, "yarn", "hdfs://n/c")) == "hdfs://n/c"


@pytest.mark.parametrize("warehouse", ["/tmp/w", "file:/tmp/w", "file:///tmp/w"])
def test_a_guess_must_be_shared(warehouse):
    conf = {"spark.sql.warehouse.dir": warehouse}
    assert storage.shared_root(Fake(conf)) == f"{warehouse}/scratch"
    with pytest.raises(RuntimeError):
        storage.shared_root(Fake(conf, "spark://host:7077"))
    assert storage.shared_root(Fake({"spark.sql.warehouse.dir": "s3a://b/w"}, "yarn")) == "s3a://b/w/scratch"
