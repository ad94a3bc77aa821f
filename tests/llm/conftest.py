import pytest

from clientele.llm.arrow import quoted

CLASHING = ["n_tokens", "shard", "kept", "component_id", "n_lines", "rule", "a b`c"]


@pytest.fixture()
def documents(spark):
    """Builds a documents table from (id, text) rows, spread over some partitions."""

    def build(rows, partitions=4):
        return spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)

    return build


@pytest.fixture()
def with_clashes():
    """Adds columns whose names an operator also uses."""

    def add(df):
        return df.selectExpr("*", *[f"'x' as {quoted(c)}" for c in CLASHING])

    return add


ODD_TEXTS = [
    None, "", " ", "\n", "a", "a b", "A b", "a b c a b c", "x\x0by\x0cz\nx y z\nx y z", "a " * 400, "q\n\n \nq\nq", "b" * 3000,
    "É\xa0é İ 日本", "\n a\n", "+1 (988) 555-2485 me@x.org 1.2.3.4", "<|endoftext|>", "tail  ",
]


@pytest.fixture()
def odd_rows():
    """Empty, NULL, long, tied and repeated rows, and NULL ids."""
    return [*enumerate(ODD_TEXTS), (3, "\n"), (3, "\n"), (None, "a b"), (None, None), (50, "a " * 400)]
