import pytest

from strata import session


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, configured=None):
        self.sparkContext = Context(master)
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: configured or default)})


def test_a_cluster_must_name_its_shared_folder():
    for master in ("yarn", "spark://host:7077", "k8s://https://host", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.checkpoint_dir(Session(master))
        assert session.checkpoint_dir(Session(master, "hdfs:///shared")) == "hdfs:///shared"


def test_a_local_session_gets_a_folder():
    for master in ("local", "local[4]", "local[*]"):
        assert session.checkpoint_dir(Session(master))


def test_other_errors_are_not_hidden():
    class Broken:
        @property
        def sparkContext(self):
            raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Broken())
