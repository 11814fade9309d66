"""The language sample holds different texts, however often they are repeated."""

from terraline.llm import langid


def test_copies_take_no_language_away(spark):
    rows = [(f"der kleine Text Nummer {k} ist kurz", "de") for k in range(3) for _ in range(2000)] + [(f"the short text number {i}", "en") for i in range(30)]
    learned = {lang: (n, sample) for lang, n, sample in langid.learn(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string"))}
    assert learned["de"][0] == 6000 and learned["en"][0] == 30
    assert learned["de"][1].count(b"der kleine text nummer") == 3 and learned["en"][1].count(b"the short text number") == 30
    for text in ("ein einzelner kleiner Text", "what a thing", "quelques mots de plus"):
        alone = spark.createDataFrame([(i, text, "xx") for i in range(5000)], "doc_id long, text string, lang string")
        assert [(lang, n) for lang, n, _ in langid.learn(alone)] == [("xx", 5000)]
