import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from searchlake.llm.common import ship_package

    spark.conf.set("spark.sql.shuffle.partitions", "4")
    ship_package(spark)


@pytest.fixture
def make(spark):
    """Rows (doc_id, text, lang, source) with extra columns whose names clash with the operators' own."""
    def run(rows, lang="en"):
        rows = [(r[0], r[1], lang, r[2] if len(r) > 2 else "a") for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        clash = "h n rank key size row kept batch part node block class host path p copies drop line_dedup".split()
        return df.withColumns({c: F.lit(None).cast("int") for c in clash})
    return run


@pytest.fixture
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
