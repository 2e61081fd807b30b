"""The checkpoint folder."""

import pytest

from ledgerline.llm import common


class Session:
    """As much of a session as the check of its folder looks at."""

    def __init__(self, master, shared):
        self.sparkContext = self
        self.conf = self
        self.master, self.shared, self.used = master, shared, None

    def get(self, name, otherwise=None):
        return self.shared or otherwise

    def getCheckpointDir(self):  # noqa: N802
        return self.used

    def setCheckpointDir(self, folder):  # noqa: N802
        self.used = folder


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        common.ensure_checkpoints(Session("spark://host:7077", None))
    for master, shared in (("spark://host:7077", "hdfs:///cp"), ("local[4]", None), ("local-cluster[2,1,512]", "/shared")):
        session = Session(master, shared)
        common.ensure_checkpoints(session)
        assert session.used == (shared or "/tmp/checkpoints")
