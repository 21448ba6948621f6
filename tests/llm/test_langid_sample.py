"""The bounded training sample of the language model."""

from nestmart.llm.langid import _sample, fit_languages


def test_rare_language_is_learned_from_a_large_table(spark):
    rows = [(k, f"abcde bcdea {k % 7 * 'c'}", "aa") for k in range(400)]
    rows += [(1000, "abcde hot", "aa")] * 300 + [(2000, "fghij ghijf", "bb"), (2001, "jihgf", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = fit_languages(docs, texts=5)
    assert model.predict("ghij fgh")[0] == "bb" and model.predict("abcd eab")[0] == "aa"
    sample = _sample(docs.withColumnRenamed("doc_id", "id"), 5).collect()
    assert sum(r.lang == "aa" for r in sample) == 5
    assert {r.id for r in sample if r.lang == "bb"} == {2000, 2001}
