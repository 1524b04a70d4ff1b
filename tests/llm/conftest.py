import pytest

from flowgauge.llm.common import ship

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that operators use inside, as columns of the input.
CLASHING = "fp key h1 n rank score words gone kept c0 item_id y held fixed file block hash _ids digest maybe whole".split()


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with extra columns of clashing names."""

    def build(rows, partitions=3):
        extra = "".join(f", {c} string" for c in CLASHING)
        full = [(i, t, None, "src", None, *["x"] * len(CLASHING)) for i, t in rows]
        return spark.createDataFrame(full, DOCS + extra).repartition(partitions)

    return build

