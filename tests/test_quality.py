from sparkdesk.operators.quality import profile, uniqueness
from sparkdesk.plans.quality import COMPLIANCE, PRODUCT_COLUMNS

SCHEMA = ("id long, vendor_code string, name string, type string, label string, price double, "
          "discount double, available_count long, preorder_count long")


def metrics(df):
    return {(r.entity, r.instance, r.name): r.value for r in df.collect()}


def test_profile_on_edge_products(spark):
    data = [
        (1, "v", "a", "t", "l", 1.0, -1.0, 1, 0),
        (1, "v", None, "t", "l", 1.0, 0.0, -1, 0),
        (2, "v", "b", "t", "l", 1.0, 100.0, 1, -3),
        (None, "v", "c", "t", "l", 1.0, 101.0, 1, 0),
        (None, "v", "d", "t", "l", 1.0, None, None, 0),
        (3, "v", "e", "t", "l", None, 50.0, 0, 0),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    m = metrics(profile(df, completeness=PRODUCT_COLUMNS, unique=[["id"]], compliance=COMPLIANCE))
    assert m[("Dataset", "*", "Size")] == 6.0
    assert m[("Column", "id", "Completeness")] == 4 / 6
    assert m[("Column", "name", "Completeness")] == 5 / 6
    # ids 2 and 3 occur once; 1 twice; NULL ids are not values but count in the denominator
    assert m[("Column", "id", "Uniqueness")] == 2 / 6
    assert m[("Column", "discount less than 0", "Compliance")] == 1 / 6
    assert m[("Column", "discount bigger than 100", "Compliance")] == 1 / 6   # NULL is not satisfied
    assert m[("Column", "available_count less than 0", "Compliance")] == 1 / 6
    assert m[("Column", "preorder_count less than 0", "Compliance")] == 1 / 6
    assert len(m) == 1 + 9 + 1 + 4


def test_profile_on_empty_table_keeps_only_defined_metrics(spark):
    df = spark.createDataFrame([], SCHEMA)
    m = metrics(profile(df, completeness=PRODUCT_COLUMNS, unique=[["id"]], compliance=COMPLIANCE))
    assert m == {("Dataset", "*", "Size"): 0.0}


def test_multicolumn_uniqueness(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, None), (None, 3)], "a int, b int")
    m = metrics(uniqueness(df, ["a", "b"]))
    assert m == {("Multicolumn", "a,b", "Uniqueness"): 2 / 5}
