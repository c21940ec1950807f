"""Changes and predicates: hand-picked cases, and random texts against plain Python."""

import random

import pytest
import scalar
from pyspark.sql import functions as F

from pairloom.functions import pair_predicates as pp
from pairloom.functions import predicates as p
from pairloom.functions.registry import CHANGES, PREDICATES

PIECES = (
    list("aZsSäß09_-.@()[]{}\"' \t\n\r\x00\x01\x1c\x1f\x7f\x85\xa0\xad​  　ªΩ漢😀𐐀²ſ")
    + list("„“”‚‘’«»‹›‛‟")
    + list("%+--..@@")
    + ["http://", "ftp://", "www.", "a.de", "über.der", "x@y.org", "' s", "s' ", "don’t", "()", "“”", "Ende.Der", "минута"]
)


@pytest.fixture(scope="module")
def random_texts(spark):
    rng = random.Random(20)
    texts = {"".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(6000)}
    texts |= {"".join(rng.choice(PIECES) for _ in range(rng.randint(30, 200))) for _ in range(300)}
    texts = sorted(texts)
    return spark.createDataFrame([(t,) for t in texts], "t string").repartition(4).cache()


def values(df, column):
    return {row["t"]: row["v"] for row in df.select("t", column.alias("v")).collect()}


@pytest.mark.parametrize("name", list(CHANGES))
def test_change_on_random_texts(random_texts, name):
    got = values(random_texts, CHANGES[name](F.col("t")))
    assert {t: v for t, v in got.items() if v != getattr(scalar, name)(t)} == {}


@pytest.mark.parametrize(
    "name",
    [n for n in PREDICATES if hasattr(scalar, n)],
)
def test_predicate_on_random_texts(random_texts, name):
    got = values(random_texts, PREDICATES[name](F.col("t")))
    wrong = {t: v for t, v in got.items() if v != getattr(scalar, name)(t)}
    assert wrong == {}
    assert len(set(got.values())) == 2


@pytest.mark.parametrize("least, share", [(3, 0.5), (5, 0.9), (0, 0.2), (1, 1.0), (1, 1.5)])
def test_script_share_on_random_texts(random_texts, least, share):
    column = p.target_not_latin_like(F.col("t"), min_letters=least, min_latin_ratio=share)

    def expected(t):
        letters = [c for c in t if c.isalpha()]
        # No letters at all: nothing to judge.
        return bool(letters) and scalar.target_not_latin_like(t, least, share)

    got = values(random_texts.where("t rlike '[a-z]'"), column)
    assert {t: v for t, v in got.items() if v != expected(t)} == {}


def single(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("v")).first()["v"]


CASES = [
    ("contains_url", "über.der Ende", {}, False),
    ("contains_url", "Ende.Der", {}, True),
    ("contains_url", "HTTP://x", {}, False),
    ("contains_url", "see www.", {}, True),
    ("contains_url", "ü-.de", {}, True),
    ("contains_email", "a.b@ex.org", {}, True),
    ("contains_email", "a@b.comü", {}, False),
    ("contains_german_chars", "Straße", {}, True),
    ("contains_german_chars", "street", {}, False),
    ("is_blank", " \x1f\x85　", {}, True),
    ("is_blank", "", {}, True),
    ("is_blank", "​", {}, False),
    ("is_too_short", "😀", {"min": 2}, True),
    ("is_too_short", "ab", {"min": 2}, False),
    ("is_too_long", "abc", {"max": 2}, True),
    ("is_too_long", "ab", {"max": 2}, False),
    ("contains_control_chars", "a\tb", {}, False),
    ("contains_control_chars", "a\tb", {"allow": ""}, True),
    ("contains_control_chars", "a\x9fb", {}, True),
    ("contains_invisible_format_chars", "a\xadb", {}, True),
    ("contains_invisible_format_chars", "a\xa0b", {}, False),
    ("has_odd_number_of_quotes", "minute' s", {}, False),
    ("has_odd_number_of_quotes", "students'", {}, False),
    ("has_odd_number_of_quotes", "don’t", {}, False),
    ("has_odd_number_of_quotes", "5' tall", {}, True),
    ("has_odd_number_of_quotes", 'say "hi', {}, True),
    ("has_odd_number_of_quotes", "a 'b", {"quote_chars": '"'}, False),
    ("has_odd_number_of_quotes", "don't \"x", {"quote_chars": "'"}, False),
    ("has_odd_number_of_quotes", "x", {"quote_chars": ""}, False),
    ("has_unbalanced_brackets", "„Hallo“", {}, True),
    ("has_unbalanced_brackets", "»Hallo«", {}, True),
    ("has_unbalanced_brackets", "“Hello”", {}, False),
    ("has_unbalanced_brackets", "don’t", {}, True),
    ("has_unbalanced_brackets", "([)]", {}, True),
    ("has_unbalanced_brackets", "a (b [c] {d}) e", {}, False),
    ("has_unbalanced_brackets", ")(", {}, True),
    ("has_unbalanced_brackets", "()((", {}, True),
    ("target_not_latin_like", "Ελληνικά κείμενο εδώ και εκεί", {}, True),
    ("target_not_latin_like", "Ελληνικά", {}, False),
    ("target_not_latin_like", "ªª", {"min_letters": 1}, True),
]


@pytest.mark.parametrize("name, text, options, expected", CASES)
def test_predicate_cases(spark, name, text, options, expected):
    assert single(spark, text, PREDICATES[name](F.col("t"), **options)) is expected


def test_change_order_matters(spark, make_pairs):
    from pairloom import norm

    chain = ["strip_edges", "remove_control_chars", "collapse_whitespace", "normalize_unicode_quotes"]
    row = norm(make_pairs([("\x00 a\x1fb  „c“", None)]), chain).first()["translation"]
    # The space behind the control character was not at the edge when edges were cut.
    assert row["de"] == ' ab "c"'
    assert row["en"] is None


def test_long_runs_stay_cheap(spark):
    many = 200_000
    texts = {
        "a." * many + "1": (False, False),
        "a-" * many + "@": (False, False),
        "a." * many + "ab": (True, False),
        "-." * many + "ab": (False, False),
        "a.-." + "-." * many + "ab": (True, False),
        "x+" * many + "y@" + "a.1" * many: (False, False),
        "x." * many + "y@b.com": (True, True),
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = F.struct(p.contains_url(F.col("t")), p.contains_email(F.col("t")))
    assert {t: tuple(v) for t, v in values(df, both).items()} == texts


def test_long_bracket_texts(spark):
    many = 20_000
    texts = {"(" * many: True, "(" * many + ")" * many: False, "()" * many: False, ")" * many + "(" * many: True}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert values(df, p.has_unbalanced_brackets(F.col("t"))) == texts


@pytest.mark.parametrize("name, option", [("is_too_short", "min"), ("is_too_long", "max")])
def test_negative_limits(spark, name, option):
    with pytest.raises(ValueError, match="characters"):
        PREDICATES[name](F.col("t"), **{option: -1})


def test_length_ratio(spark):
    rows = [("", "a", True), ("a", "", True), ("abc", "a", False), ("abcd", "a", True), ("a", "abc", False), ("a", "abcd", True)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean")
    got = df.select("want", pp.bad_length_ratio(F.col("a"), F.col("b"), min=0.33, max=3).alias("v")).collect()
    assert all(row["want"] == row["v"] for row in got)


def test_equal_sides(spark):
    rows = [("ÄÖ", "äö", True), ("a", "b", False), ("", "", True)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean")
    assert all(r["want"] == r["v"] for r in df.select("want", pp.are_equal(F.col("a"), F.col("b")).alias("v")).collect())


def test_rejection_depends_on_seed_and_id_only(spark):
    def rejected(parts, seed, prob=0.2):
        df = spark.range(20_000).withColumn("t", F.lit("same")).repartition(parts)
        test = pp.reject_with_probability(F.col("t"), F.col("t"), prob=prob, seed=seed)
        return {row["id"] for row in df.where(test).collect()}

    first = rejected(1, 7)
    assert first == rejected(5, 7)
    assert first != rejected(1, 8)
    assert 0.18 < len(first) / 20_000 < 0.22
    assert rejected(2, 7, 0.0) == set()
    assert len(rejected(2, 7, 1.0)) == 20_000
    assert 0.15 < len(rejected(2, None)) / 20_000 < 0.25
