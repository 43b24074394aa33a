from conftest import rows
from stallbook.plans.staging import new_folder
from stallbook.sources import common_schema, lift, read_variants, shapes

FIELDS = {
    "id": ("$.id", "bigint"),
    "url": (("$.metadata.url", "$.metadata.page.url"), "string"),
    "seconds": (("$.metadata.session_duration_sec", "$.metadata.session.duration_sec"), "int"),
}


def read(spark, *lines):
    folder = new_folder(spark, "variants")
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(folder)
    return read_variants(spark, folder)


def test_members_are_found_in_every_shape(spark):
    found = lift(
        read(
            spark,
            '{"id": 1, "metadata": {"url": "a", "session_duration_sec": "30"}}',
            '{"id": 2, "metadata": {"page": {"url": "b"}, "session": {"duration_sec": 31}}, "more": [1, {"x": null}]}',
            '{"id": 3}',
            '{"id": 4, "metadata": null}',
            '{"id": 5, "metadata": {"url": null, "page": {"url": "c"}, "session_duration_sec": "long"}}',
            '{"id": "6", "metadata": {"url": 7, "session_duration_sec": [1]}}',
        ),
        FIELDS,
    )
    assert found.columns == ["id", "url", "seconds"]
    assert [(r["id"], r["url"], r["seconds"]) for r in found.orderBy("id").collect()] == [
        (1, "a", 30), (2, "b", 31), (3, None, None), (4, None, None), (5, "c", None), (6, "7", None),
    ]


def test_lines_that_are_no_objects(spark):
    found = read(spark, "{", "[1]", '"text"', "null", "", '{"id": 1}')
    assert [r["id"] for r in lift(found, FIELDS).orderBy("id").collect()] == [None, None, None, None, 1]
    assert {r["shape"]: r["documents"] for r in rows(shapes(found))} == {
        None: 1, "ARRAY<BIGINT>": 1, "STRING": 1, "VOID": 1, "OBJECT<id: BIGINT>": 1,
    }


def test_a_schema_for_all(spark):
    found = read(spark, '{"id": 1, "a": 1}', '{"id": 2, "a": "x"}', '{"id": 3, "b": true}', "{")
    assert rows(common_schema(found)) == [{"shape": "OBJECT<a: VARIANT, b: BOOLEAN, id: BIGINT>"}]


def test_no_documents(spark):
    found = read(spark)
    assert rows(lift(found, FIELDS)) == rows(shapes(found)) == []
    assert len(rows(common_schema(found))) == 1


def test_other_columns_stay_and_one_scan_is_enough(spark):
    found = read(spark, '{"id": 1}').selectExpr("document AS d", "7 AS shape")
    assert rows(lift(found, {"id": FIELDS["id"]}, "d")) == [{"shape": 7, "id": 1}]
    plan = lift(read(spark, '{"id": 1}'), FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan json") == 1
