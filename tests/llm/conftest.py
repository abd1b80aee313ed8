import tempfile

import pytest

#: A column name clash, nulls, an empty text and a repeated row in every fixture.
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture()
def written(spark):
    """Writes rows as a Parquet table and returns its path."""

    def write(rows, schema, files=2):
        path = tempfile.mkdtemp(prefix="starload-llm-") + "/table.parquet"
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return path

    return write
