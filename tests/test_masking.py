import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkdesk.functions.text import card_mask, card_mask_pandas


def test_middle_digits_are_hidden(spark):
    df = spark.createDataFrame([(7, "5500111122223333"), (8, "5500999988887777")], ["n", "pan"])
    out = df.withColumn("masked", card_mask("pan")).orderBy("n").collect()
    assert [r.masked for r in out] == ["5500XXXXXXXX3333", "5500XXXXXXXX7777"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(min_size=0, max_size=20)), min_size=1, max_size=30))
def test_native_mask_equals_pandas_slice_replace(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s string")
    out = df.select("id", card_mask("s").alias("a"), card_mask_pandas("s").alias("b")).orderBy("id").collect()
    expected = pd.Series(values, dtype=object).str.slice_replace(4, 12, "XXXXXXXX")
    for r, e in zip(out, expected):
        e = None if e is None or (isinstance(e, float) and pd.isna(e)) else e
        assert r.a == e and r.b == e


def test_edge_lengths(spark):
    vals = ["", "123", "1234", "1234567", "123456789012", "1234567890123", "ÄÖÜäöüßéèêëîïôœ"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(card_mask("s")).collect()]
    assert got == list(pd.Series(vals).str.slice_replace(4, 12, "XXXXXXXX"))
