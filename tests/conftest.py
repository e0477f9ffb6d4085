import sys
from contextlib import contextmanager
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyhouse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        "tests",
        4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(shared),
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""

    @contextmanager
    def changed(**settings):
        names = {key.replace("__", "."): value for key, value in settings.items()}
        before = {name: spark.conf.get(name, None) for name in names}
        for name, value in names.items():
            spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                spark.conf.unset(name) if value is None else spark.conf.set(name, value)

    return changed


@pytest.fixture
def many_slices(conf):
    """Keep the range slices of small inputs apart."""
    with conf(
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="7",
    ):
        yield


@pytest.fixture
def layers(spark, tmp_path):
    """Fresh layer databases below the test's folder."""
    from tallyhouse.sources.tables import Layers, ensure_layout

    tag = tmp_path.name.replace("-", "_")
    made = Layers(*[f"{name}_{tag}" for name in ("bronze", "silver", "gold", "dq")])
    ensure_layout(spark, made, str(tmp_path / "layers"))
    return made
