import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names clash with what the operators add.
CLASHING = (
    "score fp shard row words kept length rank slot run _b number doc set bands root key top clean first size part block other n ratio base_failed n_words held_out"
    " _fp _row _score _q_n_words _q_words _set _bands mark grp about bytes low high least component_id toxic fold full rest powers predicted spans a.b"
    " d t u z h a mask digest chunk marks n_bytes"
).split()


@pytest.fixture()
def docs(spark):
    def make(*texts, ids=None, clashing=True):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, x, "en", "s", None if x is None else len(x)) for i, x in zip(ids, texts)]
        frame = spark.createDataFrame(rows, DOCUMENTS)
        if clashing:
            from pyspark.sql import functions as F

            frame = frame.select("*", *(F.lit(7).alias(x) for x in CLASHING))
        return frame

    return make


@pytest.fixture()
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make
