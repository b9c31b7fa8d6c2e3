import pytest
from pyspark.sql import types as T

from millrace.llm.shipping import shipped

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use for columns of their own
    T.StructField("key", T.StringType()), T.StructField("hash", T.StringType()), T.StructField("size", T.StringType()),
    T.StructField("shard", T.StringType()), T.StructField("id", T.StringType()),
])

WORDS = "river stone cloud amber quiet north paper window garden lantern copper meadow thunder violet harbor silver".split()


def prose(seed: int, n: int = 60) -> str:
    """Words in an order of their own, with line breaks."""
    out, x = [], seed * 7919 + 13
    for k in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 50) + ("." if k % 9 == 8 else ""))
    return " ".join(out)


@pytest.fixture
def make(spark):
    """A table of documents from (doc_id, text, lang, source), with clashing columns."""

    def build(rows):
        return shipped(spark).createDataFrame([(i, t, la, s, len(t or ""), "k", "h", "s", "x", "i") for i, t, la, s in rows], DOCS)

    return build


@pytest.fixture
def odd(make):
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    base = [(i, prose(i), ("en", "de", None)[i % 3], ("a", "b", "hot", "hot", None)[i % 5]) for i in range(40)]
    return make(base + [
        (40, None, None, None), (41, "", "en", "a"), (42, " \n\t ", "de", "b"), (43, prose(1, 30_000), "en", "hot"),
        (44, prose(3), "en", "a"), (44, prose(3), "en", "a"), (None, prose(5), "en", "a"), (None, None, None, None),
        (45, "日本語 テキスト ☃", None, "c"), (46, "x" * 300_000, "en", "hot"), (47, "12 34 5", "en", "b"),
    ])


@pytest.fixture
def empty(make):
    return make([])
