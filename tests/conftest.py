import pytest
from pyspark.sql import functions as F

from contentloom.schemas import schema
from contentloom.sources.storage import FolderStore
from tests.compare import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = local_session(4, **folders)
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Values of a column function over a list of values of one type."""

    def run(function, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]

    return run


@pytest.fixture
def store_with_posts(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path / "tables"))
    row = (1, "Sub", "Title", "a", "u", 5, None, None)
    store.append("reddit_posts", spark.createDataFrame([row], schema("reddit_posts")))
    return store
