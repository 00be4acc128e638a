import numpy as np

from tallgrass.llm import language_id


def test_several_languages_and_short_texts_stay(spark):
    rng = np.random.default_rng(5)
    parts = {"en": "the of and ing tion er".split(), "de": "der und sch ung ein ich".split(), "fr": "le que eau ment oi ré".split(), "fi": "kki ssa yö aa tta nen".split()}
    text = lambda lang: " ".join("".join(rng.choice(parts[lang], 2)) for _ in range(100))
    rows = [(i, text(lang), lang) for i, lang in enumerate(list(parts) * 20)]
    rows += [(900, " ".join(text(x) for x in ("en", "fr", "de")), None), (901, " ".join(map(text, parts)), None), (902, "ok", None), (903, "A.", None), (904, "12 !!", None), (905, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in language_id.recognised(table).collect()}
    assert kept == {i for i, _, _ in rows} - {904, 905}
    bare = language_id.recognised(table.withColumn("lang", table["lang"].substr(1, 0)).replace("", None))
    assert {r.doc_id for r in bare.collect()} == kept


def test_other_languages_and_numbers_go(spark):
    """A text goes where known languages make up less than the least share of it: by its n-grams, or by its characters."""
    rng = np.random.default_rng(6)
    parts = {"en": "the of and ing tion er".split(), "de": "der und sch ung ein ich".split(), "xx": "zvk qoj wyp xub jiq kwo".split()}
    text = lambda lang, n=100: " ".join("".join(rng.choice(parts[lang], 2)) for _ in range(n))
    rows = [(i, text(lang), lang) for i, lang in enumerate(["en", "de"] * 30)]
    rows += [(800, text("xx"), None), (801, text("xx", 90) + " " + text("en", 10), None), (802, "4325404893167225 20.118.157.107 +1 (726) 555-7857 the and of", None)]
    rows += [(900, text("en", 70) + " " + text("xx", 30), None), (901, "zv", None), (902, text("de") + " 4325404893167225", None)]
    kept = {r.doc_id for r in language_id.recognised(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert kept == {i for i, _, _ in rows} - {800, 801, 802}
