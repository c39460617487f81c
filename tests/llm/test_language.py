import zlib

from pyspark.sql import functions as F

from chartframes.llm import language, queries
from chartframes.llm.common import held_out


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op3(spark, folder).collect()
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    tested = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) / len(tested) > 0.97


def test_odd_rows(spark):
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate([("das ist gut so", "de"), ("this is good", "en"), ("c'est bon ça", "fr")] * 6)]
    odd = [(100, None, "de", None, 2), (101, "", "en", "s", 3), (102, "12 #! \n", None, "s", 4), (103, "ça " * 60_000, None, "s", 5), (None, "this is", None, "s", 6), (1, "this is good", "en", "s", 1)]
    df = spark.createDataFrame([*rows, *odd], "doc_id long, text string, lang string, lang_pred string, score int")
    model = language.fit(df, F.lit(True))
    assert model.members == {"germanic": ["de", "en"], "romance": ["fr"]}
    got = language.identify(df, model).collect()
    assert len(got) == len(rows) + len(odd)
    found = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert found[100] == found[101] == found[102] == ("und", 0.0)
    assert found[103][0] == "fr" and found[None][0] == "en" and found[0][0] == "de"
    kept = language.known_language(df, F.lit(True))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == set(found) - {100, 101, 102}
    nothing = language.fit(df.limit(0), ~held_out())
    assert {r.lang_pred for r in language.identify(df, nothing).collect()} == {"und"}
    assert language.identify(df.limit(0), nothing).collect() == []
    one = language.fit(df.where("lang = 'de'"), F.lit(True))
    assert {(r.lang_pred, r.score) for r in language.identify(df.where("doc_id = 0"), one).collect()} == {("de", 1.0)}


def test_more_than_two_languages_of_a_family(spark):
    texts = {"en": "the house of this is and with", "de": "das haus und nicht mit der", "nl": "het huis en niet met een", "es": "la casa que con los", "pt": "uma casa não com os"}
    rows = [(i * 10 + j, " ".join(t.split()[j % 3 :]), k) for i, (k, t) in enumerate(texts.items()) for j in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, F.lit(True))
    assert len(model.levels["germanic"][1]) == 3 and len(model.levels[""][1]) == 1
    got = language.identify(df, model).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.lang == r.lang_pred for r in got)


def test_rejects_by_score_and_keeps_letters_if_nothing_is_learned(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    other = [(-1, "Мама мыла раму и пошла в лес", None), (-2, "東京は日本の首都です", None), (-3, "12 !", None), (-4, None, None)]
    df = spark.createDataFrame(rows + other, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in language.known_language(df, ~held_out()).collect()}
    assert kept == {d for d, t, _ in rows if any(c.isalpha() for c in t or "")}
    unlabelled = df.where("doc_id < 5").withColumn("lang", F.lit(None).cast("string"))
    letters = {d for d, t, _ in rows + other if d < 5 and any(c.isalpha() for c in t or "")}
    for learn, docs in ((~held_out(), unlabelled), (F.lit(False), df.where("doc_id < 5"))):
        assert {r.doc_id for r in language.known_language(docs, learn).collect()} == letters
