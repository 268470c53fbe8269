import os
import shutil
import time

import pytest

from millrace.session import build_session

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[8]", 2, spark__driver__memory="6g",
        spark__sql__warehouse__dir=home / "warehouse", spark__checkpoint__dir=home / "checkpoints",
        spark__driver__extraJavaOptions=f"-Dderby.system.home={home}",
        spark__sql__catalogImplementation="hive",
        spark__hadoop__javax__jdo__option__ConnectionURL=f"jdbc:derby:;databaseName={home}/metastore;create=true")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tight(spark):
    """Treat keys with more than 3 rows as hot, so that the split paths run."""
    from millrace.operators.ordered import MAX_ROWS_CONF

    spark.conf.set(MAX_ROWS_CONF, "3")
    yield
    spark.conf.unset(MAX_ROWS_CONF)


@pytest.fixture
def replay(spark, tmp_path):
    """Frames as a stream that delivers one frame per micro-batch."""

    def run(*frames):
        folder = tmp_path / f"in{time.time_ns()}"
        folder.mkdir()
        for i, frame in enumerate(frames):
            staged = tmp_path / f"staged{time.time_ns()}"
            frame.coalesce(1).write.parquet(str(staged))
            part = next(p for p in staged.iterdir() if p.suffix == ".parquet")
            target = folder / f"{i:04d}.parquet"
            shutil.copy(part, target)
            os.utime(target, (1_600_000_000 + i * 10, 1_600_000_000 + i * 10))
        return (spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(str(folder)))

    return run


@pytest.fixture
def drain(spark, tmp_path):
    """Run a streaming frame to its end and give back its rows."""

    def run(df, mode="append", checkpoint=None):
        name = f"out_{time.time_ns()}"
        query = (df.writeStream.outputMode(mode).format("memory").queryName(name)
                 .option("checkpointLocation", checkpoint or str(tmp_path / name))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        return spark.table(name)

    return run


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
