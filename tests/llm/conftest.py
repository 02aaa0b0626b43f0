import pytest
from pyspark.sql import SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside, as extra columns.
CLASHES = "doc string, content string, spans string, lines string, host string, prior string, score string, old string, part string, kind string, places string, turn string, at string, id string, chunk string, `cell_source` string"


@pytest.fixture
def documents(spark: SparkSession):
    """Rows of ``documents``: (doc_id, text[, lang[, source]])."""

    def make(*rows, extra: bool = False):
        full = [
            (i, t, (more + ("en",))[0] if more else "en", more[1] if len(more) > 1 else "src0", len(t or ""))
            for i, t, *rest in rows
            for more in [tuple(rest)]
        ]
        schema = SCHEMA
        if extra:
            schema += ", " + CLASHES
            full = [r + ("x",) * len(CLASHES.split(",")) for r in full]
        return spark.createDataFrame(full, schema)

    return make
