import pytest

from tidemark import session


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class Session:
    """The settings part of a session."""

    def __init__(self, **settings):
        self.conf = Conf({key.replace("__", "."): value for key, value in settings.items()})


def test_scratch_lies_in_the_shared_folder():
    remote = Session(spark__master="yarn", spark__checkpoint__dir="hdfs://shared/scratch/")
    first, second = (session.scratch_dir(remote, "trades") for _ in range(2))
    assert first.startswith("hdfs://shared/scratch/trades-") and first != second


def test_no_machine_local_scratch_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session(spark__master="spark://host:7077"), "trades")
    assert session.scratch_dir(Session(spark__master="local[8]"), "trades")


def test_state_store_choice_of_the_session_is_kept():
    key = "spark.sql.streaming.stateStore.providerClass"
    unset, chosen = Session(), Session()
    chosen.conf[key] = "Other"
    session.keep_state_off_heap(unset)
    session.keep_state_off_heap(chosen)
    assert unset.conf[key].endswith("RocksDBStateStoreProvider")
    assert chosen.conf[key] == "Other"


def test_a_session_has_the_recommended_settings(spark):
    for key, value in session.DEFAULTS.items():
        assert spark.conf.get(key) == value
