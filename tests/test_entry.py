"""The registry sets up what a query needs where the session does not."""

from __future__ import annotations

import __spark_entry__ as registry


class Session:
    """A session that names no shared folder, and remembers one that is given to it."""

    def __init__(self, master):
        self.master, self.folder = master, None
        self.conf = self.sparkContext = self

    def get(self, key, default=None):
        return "/data/warehouse/" if key == "spark.sql.warehouse.dir" else default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_local_session_without_a_shared_folder_gets_one():
    folder = registry._in_session(lambda spark, sf_dir: spark.folder)
    session = Session("local[2]")
    assert folder(session, "") == "/data/warehouse/shared" == folder(session, "")
    session.folder = "/own"
    assert folder(session, "") == "/own"
    assert folder(Session("spark://host:7077"), "") is None
