"""Normalization, flaws, encoding and training rows, with their reports."""

import time

import pytest
from pyspark.sql import functions as F

from pairloom import schemas
from pairloom.functions.codecs import ExternalCodec, FileCodec, WordLengthCodec, training_token_ids
from pairloom.functions.predicates import has_unbalanced_brackets
from pairloom.functions.registry import register_predicate
from pairloom.operators.encode import encode_pairs, tokenize, tokenize_report
from pairloom.operators.flaws import filter_pairs, find_flaws, flaw_report, keep
from pairloom.operators.normalize import norm, norm_report
from pairloom.operators.summaries import flaw_counts, pair_flaw_counts
from pairloom.operators.training import map_training, with_markers


def as_dicts(df, order="id"):
    return [row.asDict(recursive=True) for row in df.orderBy(order).collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- normalization ------------------------------------------------------------


def test_empty_chain_is_identity(make_pairs):
    df = make_pairs([(" Tag  ", "\n morning ")], start_id=7).withColumn("extra", F.lit(1))
    assert norm(df).collect() == df.collect()
    assert norm(df, []).columns == df.columns


def test_changes_are_reported_per_side(make_pairs):
    df = make_pairs([(" guten \t Tag ", "\n morning "), ("sauber", "clean"), ("a", "b  c"), (None, " x")], start_id=5)
    annotated = norm(df, ["strip_edges", "collapse_whitespace"], annotate=True, debug=True)
    assert as_dicts(norm_report(annotated, start_id=5), "seq_no") == [
        {"seq_no": 1, "de_norm_changes": ["strip_edges", "collapse_whitespace"], "en_norm_changes": ["strip_edges"]},
        {"seq_no": 3, "de_norm_changes": [], "en_norm_changes": ["collapse_whitespace"]},
        {"seq_no": 4, "de_norm_changes": [], "en_norm_changes": ["strip_edges"]},
    ]
    report = norm_report(annotated, start_id=5, debug=True)
    assert report.schema.fieldNames() == schemas.norm_report(debug=True).fieldNames()
    assert as_dicts(report, "seq_no")[0] | {"seq_no": 0} == {
        "seq_no": 0,
        "de_norm_changes": ["strip_edges", "collapse_whitespace"],
        "en_norm_changes": ["strip_edges"],
        "de_before": " guten \t Tag ",
        "de_after": "guten Tag",
        "en_before": "\n morning ",
        "en_after": "morning",
    }


def test_each_change_runs_once_per_text(make_pairs):
    chain = ["strip_edges", "remove_control_chars", "collapse_whitespace", "fix_apostrophe_spacing"]
    df = make_pairs([("a", "b")]).checkpoint()
    report = norm_report(norm(df, chain, annotate=True))
    assert plan(report).count("regexp_replace(") == 2 * 3
    clean = filter_pairs(norm(df, chain), ["is_blank", "contains_url", ["is_too_long", {"max": 9}]])
    assert plan(clean).count("regexp_replace(") == 2 * 3


# --- flaws --------------------------------------------------------------------

TESTS = ["is_blank", ["is_too_short", {"min": 3}], "contains_url"]
PAIR_TESTS = [["bad_length_ratio", {"min": 0.33, "max": 3}], "are_equal"]
PAIRS = [("gut so", "good one"), ("  ", "a.de/x"), ("gleich", "GLEICH"), (None, "text"), ("ein langer Satz", "abc")]


def test_flaws_in_configured_order(make_pairs):
    annotated = find_flaws(make_pairs(PAIRS, start_id=3), TESTS, PAIR_TESTS)
    short, ratio = "is_too_short(min=3)", "bad_length_ratio(min=0.33, max=3)"
    assert as_dicts(flaw_report(annotated, start_id=3), "seq_no") == [
        {"seq_no": 2, "de_flaws": ["is_blank", short], "en_flaws": ["contains_url"], "pair_flaws": []},
        {"seq_no": 3, "de_flaws": [], "en_flaws": [], "pair_flaws": ["are_equal"]},
        {"seq_no": 4, "de_flaws": ["is_blank", short], "en_flaws": [], "pair_flaws": [ratio]},
        {"seq_no": 5, "de_flaws": [], "en_flaws": [], "pair_flaws": [ratio]},
    ]


def test_each_test_runs_once_per_text(make_pairs):
    tests = ["contains_invisible_format_chars", "contains_german_chars"]
    annotated = find_flaws(make_pairs(PAIRS).checkpoint(), tests, PAIR_TESTS)
    for df in (annotated, flaw_report(annotated), keep(annotated), flaw_counts(annotated)):
        assert plan(df).count("RLIKE(") == 2 * 2
    assert plan(pair_flaw_counts(annotated)).count("lower(") == 2


def test_kept_and_flawed_make_up_the_input(make_pairs):
    df = make_pairs(PAIRS)
    annotated = find_flaws(df, TESTS, PAIR_TESTS)
    kept = keep(annotated)
    assert kept.columns == df.columns
    assert kept.count() + flaw_report(annotated).count() == df.count()
    assert kept.collect() == filter_pairs(df, TESTS, PAIR_TESTS).collect()
    assert [row["id"] for row in kept.collect()] == [0]


def test_a_null_verdict_is_no_flaw(make_pairs):
    register_predicate("odd_length", lambda text: F.when(F.length(text) > 3, F.length(text) % 2 == 1))
    df = make_pairs([("ab", "cd"), ("abcde", "ab"), ("abcdef", "x")])
    for kept in (filter_pairs(df, ["odd_length"]), keep(find_flaws(df, ["odd_length"]))):
        assert sorted(row["id"] for row in kept.collect()) == [0, 2]


def test_rejection_uses_the_named_id(make_pairs):
    df = make_pairs([("a", "b")] * 200).withColumn("row", F.col("id") + 1000).drop("id")
    entry = [["reject_with_probability", {"prob": 0.5}]]
    kept = {r["row"] for r in filter_pairs(df, None, entry, id_field="row").collect()}
    annotated = find_flaws(df, None, entry, id_field="row")
    assert kept == {r["row"] for r in keep(annotated).collect()} and 60 < len(kept) < 140
    assert {tuple(r["pair_flaws"]) for r in annotated.collect()} == {(), ("reject_with_probability(prob=0.5)",)}


@pytest.mark.parametrize("shape", ["nested", "mismatched", "flat", "stairs"])
def test_brackets_take_linear_time(spark, shape):
    n = 200_000
    text, flawed = {
        "nested": ("(" * n + ")" * n, False),
        "mismatched": ("(" * n + "[" + ")" * n + "]", True),
        "flat": ("()[]" * (n // 2), False),
        "stairs": (("(" * 300 + "{}" + ")" * 300) * (n // 300), False),
    }[shape]
    df = spark.createDataFrame([(text,)], "text string")
    begin = time.perf_counter()
    assert df.select(has_unbalanced_brackets(F.col("text"))).first()[0] is flawed
    assert time.perf_counter() - begin < 60


def test_no_tests_keep_everything(make_pairs):
    df = make_pairs(PAIRS)
    assert filter_pairs(df).count() == keep(find_flaws(df)).count() == len(PAIRS)


# --- encoding -----------------------------------------------------------------


class Words:
    """The external form of the word-length codec."""

    eos_token_id, pad_token_id, unk_token_id, vocab_size = 0, 58, 1, 59

    def __call__(self, text, truncation=False, max_length=None):
        ids = [len(word) for word in text.split()][: max_length if truncation else None]
        return {"input_ids": ids, "attention_mask": [1] * len(ids)}

    def decode(self, ids, skip_special_tokens=True):
        return " " + " ".join("x" * i for i in ids if i)


@pytest.fixture(params=["built in", "external"])
def codec(request):
    return WordLengthCodec() if request.param == "built in" else ExternalCodec(Words, "words")


def test_structure_and_truncation(make_pairs, codec):
    df = make_pairs([("ab cde f ghij klm", "no pqrst uv"), ("", None)])
    rows = as_dicts(encode_pairs(df, codec, tokenizer_kwargs={"truncation": True, "max_length": 3}))
    assert rows[0]["translation"] == {"de": "ab cde f ghij klm", "en": "no pqrst uv"}
    assert rows[0]["tokenized_translation"] == {
        "de": {"input_ids": [2, 3, 1], "attention_mask": [1, 1, 1]},
        "en": {"input_ids": [2, 5, 2], "attention_mask": [1, 1, 1]},
    }
    assert rows[1]["tokenized_translation"]["de"] == {"input_ids": [], "attention_mask": []}
    assert rows[1]["tokenized_translation"]["en"] == {"input_ids": [], "attention_mask": []}


def test_built_in_and_external_agree(make_pairs):
    texts = [" a bb\x1fccc ", "\x85", "漢字 😀 x", "tab\tnewline\n"]
    df = make_pairs([(t, t[::-1]) for t in texts])
    one, two = (encode_pairs(df, c).orderBy("id").collect() for c in (WordLengthCodec(), ExternalCodec(Words, "w")))
    assert one == two


LENGTHS = [
    ("a b c d e f", "g"),
    ("a", "b c d"),
    ("a b c", "d e"),
    ("a", "b"),
]


def test_overlong_pairs_are_dropped(make_pairs, codec):
    df = make_pairs(LENGTHS, start_id=1)
    assert [r["id"] for r in as_dicts(tokenize(df, codec, max_seq_len=3))] == [3, 4]
    assert tokenize(df, codec).count() == 4
    # With the sides exchanged, the limit without room is that of the other side.
    assert [r["id"] for r in as_dicts(tokenize(df, codec, max_seq_len=3, src_lang="en"))] == [2, 4]


def test_tokenize_report(make_pairs, codec):
    df = make_pairs(LENGTHS, start_id=1)
    report = tokenize_report(encode_pairs(df, codec), 3)
    assert report.schema.fieldNames() == schemas.tokenize_report().fieldNames()
    assert as_dicts(report, "seq_no") == [
        {"seq_no": 1, "token_lengths": None, "removed_id": 1},
        {"seq_no": 2, "token_lengths": None, "removed_id": 2},
        {"seq_no": 3, "token_lengths": {"de": 3, "en": 2}, "removed_id": None},
        {"seq_no": 4, "token_lengths": {"de": 1, "en": 1}, "removed_id": None},
    ]


def test_tokenize_report_without_limit_and_with_text_ids(make_pairs):
    df = make_pairs(LENGTHS).withColumn("id", F.concat(F.lit("sample-"), F.col("id")))
    rows = as_dicts(tokenize_report(encode_pairs(df, WordLengthCodec())), "seq_no")
    assert [r["seq_no"] for r in rows] == [1, 2, 3, 4]
    assert all(r["removed_id"] is None for r in rows)


def test_encoding_runs_once_when_overlong_pairs_are_dropped(make_pairs):
    kept = tokenize(make_pairs(LENGTHS).checkpoint(), ExternalCodec(Words, "words"), max_seq_len=3)
    assert plan(kept).count("ArrowEvalPython") == 1


def test_file_codec(make_pairs, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    model = tokenizers.models.WordLevel({"</s>": 0, "<unk>": 1, "hallo": 2, "welt": 3}, unk_token="<unk>")
    tokenizer = tokenizers.Tokenizer(model)
    tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    tokenizer.add_special_tokens(["</s>"])
    tokenizer.save(str(tmp_path / "t.json"))
    codec = FileCodec(str(tmp_path / "t.json"), eos=0, pad=0)
    row = encode_pairs(make_pairs([("hallo welt", "hallo x")]), codec).first()["tokenized_translation"]
    assert row["de"]["input_ids"] == [2, 3]
    assert row["en"]["input_ids"] == [2, 1]
    assert codec.vocab_size == 4
    assert training_token_ids(codec)["tgt_bos_id"] == 1
    assert codec.decode_batch([[2, 3, 0]]) == ["hallo welt"]


def test_file_codec_truncates_like_the_tokenizer(make_pairs, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    model = tokenizers.models.WordLevel({"[END]": 0, "[UNK]": 1, "a": 2, "b": 3, "c": 4}, unk_token="[UNK]")
    tokenizer = tokenizers.Tokenizer(model)
    tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    tokenizer.post_processor = tokenizers.processors.TemplateProcessing("$A [END]", special_tokens=[("[END]", 0)])
    tokenizer.enable_padding(pad_id=0, length=9)
    path = tmp_path / "t.json"
    tokenizer.save(str(path))
    codec = FileCodec(str(path), eos=0, pad=0)
    path.unlink()  # what executors need travels with the codec
    df = make_pairs([("a b c", "c"), ("b", "a b")])
    cut = encode_pairs(df, codec, tokenizer_kwargs={"truncation": True, "max_length": 3}).orderBy("id").collect()
    assert [r["tokenized_translation"]["de"]["input_ids"] for r in cut] == [[2, 3, 0], [3, 0]]
    whole = encode_pairs(df, codec).orderBy("id").collect()
    assert [r["tokenized_translation"]["de"]["input_ids"] for r in whole] == [[2, 3, 4, 0], [3, 0]]


class ListWords(Words):
    def __call__(self, texts, **options):
        rows = [Words.__call__(self, text, **options) for text in texts]
        return {name: [row[name] for row in rows] for name in ("input_ids", "attention_mask")}


def test_tokenizers_that_take_lists(make_pairs):
    df = make_pairs([("ab cde", "f"), ("", None)])
    one, two = (encode_pairs(df, c).orderBy("id").collect() for c in (ExternalCodec(Words, "w"), ExternalCodec(ListWords, "w", lists=True)))
    assert one == two


def test_training_token_ids():
    assert training_token_ids(ExternalCodec(Words, "words")) == {
        "src_pad_id": 58,
        "tgt_pad_id": 58,
        "tgt_bos_id": 59,
        "tgt_eos_id": 0,
    }
    codec = WordLengthCodec()
    codec.bos_token_id = 5
    assert training_token_ids(codec)["tgt_bos_id"] == 5
    codec.eos_token_id = None
    with pytest.raises(ValueError, match="eos_token_id"):
        training_token_ids(codec)


# --- training rows ------------------------------------------------------------


def encoded_rows(spark, src, tgt):
    schema = schemas.tokenized_pairs(fields=("input_ids",))
    row = (9, ("nur ein Satz", "just a sentence"), ((src,), (tgt,)))
    return spark.createDataFrame([row], schema)


def test_map_projects_to_the_training_schema(spark):
    df = encoded_rows(spark, [3, 8, 5, 2], [3, 4])
    mapped = map_training(df, src_lang="de", tgt_lang="en", include_text=True)
    assert as_dicts(mapped) == [
        {"id": 9, "src_ids": [3, 8, 5, 2], "tgt_ids": [3, 4], "src_text": "nur ein Satz", "tgt_text": "just a sentence"}
    ]
    assert mapped.schema.simpleString() == schemas.training_rows(True).simpleString()
    assert map_training(df, src_lang="en", tgt_lang="de").columns == ["id", "src_ids", "tgt_ids"]


def test_map_takes_other_keys(spark):
    df = encoded_rows(spark, [1], [2]).withColumnsRenamed({"id": "key", "tokenized_translation": "tok"})
    row = map_training(df, src_lang="de", tgt_lang="en", id_key="key", tokenized_key="tok").first()
    assert row.asDict() == {"id": 9, "src_ids": [1], "tgt_ids": [2]}


@pytest.mark.parametrize(
    "ids, bos, eos, expected",
    [
        ([40, 41, 0], 99, 0, [99, 40, 41, 0]),
        ([99, 40], 99, 0, [99, 40, 0]),
        ([], 99, 0, [99, 0]),
        ([], 5, 5, [5]),
        ([7], None, 0, [7, 0]),
        ([7], 3, None, [3, 7]),
        ([7], None, None, [7]),
        ([5], 5, 5, [5]),
        ([5, 6], 5, 5, [5, 6, 5]),
    ],
)
def test_markers(spark, ids, bos, eos, expected):
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    assert df.select(with_markers(F.col("ids"), bos, eos)).first()[0] == expected
