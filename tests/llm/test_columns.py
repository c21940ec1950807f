"""Extra columns, whatever their names, in every stage of the pipeline; the bound of the language sample."""

import random

import pytest
from pyspark.sql import functions as F

from pairloom.llm.decontaminate import remove_leaked
from pairloom.llm.language import fit_languages, keep_identified
from pairloom.llm.line_dedup import dedup_lines
from pairloom.llm.near_dedup import keep_one_of_each

NAMES = ["__doc", "__text", "__gone", "__t", "__stays", "__language", "__leaked", "__score", "found", "key", "t", "near", "own_0", "lang_pred", "distance"]


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(4)
    words = {"en": "the of and to in is that it was for on are with they".split(), "fr": "le la les des un une et est dans pour que qui ne pas".split()}
    rows = []
    for k in range(60):
        lang = "en" if k % 2 else "fr"
        rows.append((k, " ".join(rnd.choice(words[lang]) for _ in range(60)) + "\nthe same line as everywhere else in here", lang))
    rows.append((100, rows[0][1], "fr"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in NAMES])


def columns_are_kept(before, after, also=()):
    assert after.columns == before.columns + list(also)
    rows = after.collect()
    assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES if n not in also)
    return {r.doc_id for r in rows}


def test_stages_keep_all_columns(spark, docs):
    assert columns_are_kept(docs, keep_identified(docs)) >= set(range(60))
    cleaned = dedup_lines(docs)
    assert columns_are_kept(docs, cleaned, ["n_lines", "n_removed"]) == {*range(60), 100}
    assert cleaned.where("n_removed > 0").count() == 60
    assert columns_are_kept(docs, keep_one_of_each(docs)) == set(range(60))
    items = spark.createDataFrame([(1, docs.where("doc_id = 7").first().text)], "item_id long, text string")
    assert columns_are_kept(docs, remove_leaked(docs, items)) == {*range(60), 100} - {7}


def test_the_sample_is_bounded_in_all(spark, docs, monkeypatch):
    many = docs.where("lang = 'en'").withColumn("lang", F.concat(F.lit("l"), (F.col("doc_id") % 10).cast("string")))
    many = many.crossJoin(spark.range(40)).withColumn("doc_id", F.col("doc_id") * 40 + F.col("id"))
    seen = []
    from pairloom.llm import language

    monkeypatch.setattr(language, "LanguageModel", lambda x, langs, families: seen.append(langs))
    fit_languages(many, sample=100, total=200)
    fit_languages(many, sample=100, total=200, most_languages=3)
    assert 100 < len(seen[0]) < 330 and len(set(seen[0])) == 5
    assert len(set(seen[1])) == 3
