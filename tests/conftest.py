import pytest
from pyspark.sql import SparkSession

from overlake import MatchTables, Seeds, Silver, configure
from overlake.plans.ingest import transform
from tests import documents as docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    docs.write(root, docs.ALL)
    docs.write_truncated(root)
    return str(root)


@pytest.fixture(scope="session")
def ingested(spark, raw, tmp_path_factory):
    """Silver after a full load and an incremental one bringing a correction."""
    silver = str(tmp_path_factory.mktemp("silver") / "silver")
    first = transform(spark, raw, silver, "full")
    later = docs.write(tmp_path_factory.mktemp("later"), {"t20/2012/1001": docs.FIRST_CORRECTED})
    transform(spark, later, silver, "incremental")
    return silver, first


@pytest.fixture(scope="session")
def tables(spark, ingested, tmp_path_factory):
    store = str(tmp_path_factory.mktemp("store") / "gold")
    return MatchTables(Silver.read(spark, ingested[0]), Seeds.standard(spark), store)


def rows(df, *order):
    """Rows as dictionaries, sorted by the given columns or by all."""
    found = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(found, key=lambda r: [repr(r[c]) for c in (order or sorted(r))])
