from sheafline.llm import cutoff


def test_texts_are_not_joined_again(spark):
    df = spark.createDataFrame([("t", x, x) for x in ("Coffee and the sleep", "Coffee and the sleep of nurses")], "field_name string, stem string, value string")
    found = cutoff.with_longer(df)
    assert [(r["stem"], r["longer"]) for r in found.collect()] == [("Coffee and the sleep", " of nurses")]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
