import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Build a frame whose input also holds columns with names that operators use themselves."""

    def make(rows, schema):
        df = spark.createDataFrame(rows, schema)
        clashing = ("score", "n_words", "kept", "shard", "slot", "node", "first", "hits", "length")
        for name in clashing:
            if name not in df.columns:
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
