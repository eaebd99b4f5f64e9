import random

from pyspark.sql import functions as F

from parcelmart.llm.common import table
from parcelmart.llm.langid import identify_language
from parcelmart.llm.quality import remainder

SCHEMA = "doc_id long, text string, lang string, lang_pred string, key long"
SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["ção", "ñes", "lle", "qui"]}


def corpus(size):
    r = random.Random(4)
    rows = []
    for k in range(size):
        lang = r.choice(list(SYLLABLES))
        rows.append((k, " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(2, 40))), lang))
    return rows


def predict(spark, rows, usable=None, **options):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = identify_language(docs, F.lit(True) if usable is None else usable, ["doc_id", "key"], **options)
    assert got.columns == ["doc_id", "key", "lang_pred", "lang_score"]
    return [(r.doc_id, r.lang_pred, r.lang_score) for r in got.collect()]


def test_learns_and_generalises(spark):
    rows = corpus(300)
    got = {i: p for i, p, _ in predict(spark, rows, F.col("doc_id") < 100, sample=60, landmarks=20)}
    right = [got[i] == lang for i, _, lang in rows if i >= 100]
    assert sum(right) >= 0.98 * len(right)


def test_edges(spark):
    rows = corpus(30) + [(100, None, "aa"), (101, "", None), (102, "12 34 !?", "bb"), (103, "日本語", None), (None, "kato miru", None)]
    rows += [(0, "kato", None), (104, "katomi " * 50000, None), (105, "²³ ٣", None)]
    got = predict(spark, rows)
    by_id = {i: (p, s) for i, p, s in got}
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, _, s in got)
    assert by_id[100] == by_id[101] == by_id[102] == by_id[105] == ("und", 0.0)
    assert by_id[103][0] in SYLLABLES and by_id[None][0] == "aa" and by_id[104][0] == "aa"
    assert sorted(got, key=str) == sorted(predict(spark, rows), key=str)


def test_nothing_to_learn_from(spark):
    assert predict(spark, [(1, "kato", None)]) == [(1, "und", 0.0)]
    assert predict(spark, []) == []
    assert predict(spark, [(1, "kato", "aa"), (2, "ver", None)])[0][1] == "aa"


def test_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = identify_language(docs, remainder(F.col("doc_id"), 5) != 0, ["doc_id", "lang"])
    right = got.filter(remainder(F.col("doc_id"), 5) == 0).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_repeated_rows_of_one_id_and_more_languages_than_the_sample(spark):
    rows = [(k, t, lang) for k, t, lang in corpus(90)] + [(500, "kato miru " * 20, "aa")] * 300
    got = predict(spark, rows, F.col("doc_id") < 1000, sample=60, landmarks=20)
    assert len(got) == len(rows) and sum(p == lang for (_, p, _), (_, _, lang) in zip(got, rows, strict=True)) >= 0.95 * len(rows)
    many = [(k, f"kato{k} " * 5, f"l{k}") for k in range(40)]
    assert len({p for _, p, _ in predict(spark, many, sample=10)}) <= 10
