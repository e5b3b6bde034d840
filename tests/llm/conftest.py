import pytest

from shelfwise.llm.common import prepare_text


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, over several partitions."""
    prepare_text(spark)

    def build(rows, parts=3):
        return spark.createDataFrame(list(rows), "doc_id long, text string").repartition(parts)

    return build
