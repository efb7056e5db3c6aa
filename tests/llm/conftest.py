from __future__ import annotations

import pytest
from corpus_rows import altered, prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score string, size string, `rank` string"

@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) with copies, near copies, repeated rows and odd texts."""
    out = [(i, prose(i, 20 + 7 * i)) for i in range(20)]
    out += [(30 + i, out[5][1]) for i in range(6)]
    out += [(40 + i, altered(out[9][1], i, 0.01 + 0.01 * i)) for i in range(8)]
    out += [(50, None), (51, ""), (52, " \t\n"), (53, "one two"), (54, "ONE two"), (55, "***"), (56, "\n\n123 456\n"), (None, prose(3, 60)), (None, None)]
    out += [(57, prose(99, 4000)), (57, prose(99, 4000)), (58, "é ü ñ a b <|endoftext|> it's  \n x"), (59, "a\nb\na\n\nB b\na"), (3, out[3][1]), (3, "other text " * 9)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts, tmp_path_factory):
    """The texts as a written table with columns whose names operators use themselves."""
    rows = [(i, t, ("xx", "yy", None)[k % 3], ("s1", "s2", None, "s1")[k % 4], None if t is None else len(t), "x", "y", "z", "r") for k, (i, t) in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
