"""Where written intermediate tables go."""

from types import SimpleNamespace

import pytest

from stationspark.session import shared_dir


def session(master, named=None, checkpoint=None):
    conf = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": "/w/"}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: conf[key]),
                           sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint))


def test_the_named_folder_is_used_on_any_master():
    for master in ("local[8]", "spark://host:7077", "yarn", "local-cluster[3,2,1000]"):
        assert shared_dir(session(master, "s3://shared/dir/")) == "s3://shared/dir"
        assert shared_dir(session(master, None, "/checkpoints")) == "/checkpoints"


def test_only_a_local_session_may_leave_it_unset():
    assert shared_dir(session("local[*]")) == shared_dir(session("local")) == "/w/_scratch"
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1000]"):
        with pytest.raises(RuntimeError):
            shared_dir(session(master))
