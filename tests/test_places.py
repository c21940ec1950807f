"""Rows by their place in files: order, slices, limits, and the place of a bad record."""

import json

import pytest
from pyspark.sql import functions as F

import pairloom
from pairloom.sources import places
from pairloom.sources.pairs import read_records, read_report
from pairloom.sources.places import Source, natural, parse_split

NAMES = ["part-9.jsonl", "part-10.jsonl", "part-100 é%.jsonl"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Three files of 100 numbered records each, in natural order, with blank lines, under an odd path."""
    folder = tmp_path_factory.mktemp("lines") / "a+ é%25"
    folder.mkdir()
    for f, name in enumerate(NAMES):
        lines = [json.dumps({"k": 100 * f + i, "de": "x" * (i % 9), "en": "Grüße"}, ensure_ascii=False) for i in range(100)]
        (folder / name).write_text("\n\n".join(lines) + "\n", "utf-8")
    return str(folder)


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df, spark):
    return df.select(F.input_file_name().alias("f")).distinct().count()


CASES = {
    "train": range(300),
    "train[:150]": range(150),
    " train[ 250: ] ": range(250, 300),
    "train[-5:]+train[:3]": [*range(295, 300), 0, 1, 2],
    "train[99:101]+train[10%:20%]": [99, 100, *range(30, 60)],
    "train[-10%:]": range(270, 300),
    "train[33%:34%]": range(99, 102),
    "train[20:10]": [],
    "train[290:1000]+train[290:1000]": [*range(290, 300), *range(290, 300)],
}


@pytest.mark.parametrize("split", CASES)
@pytest.mark.parametrize("limit", [None, 4, 120])
def test_slices_of_lines(spark, folder, small_blocks, split, limit):
    df = pairloom.load(spark, "json", split=split, data_files={"train": folder}, max_examples=limit, start_id=7)
    got = sorted((r.id, r.k) for r in df.collect())
    assert got == list(enumerate(CASES[split], start=7))[: len(CASES[split]) if limit is None else limit]
    if limit is None:
        assert "rangepartitioning" not in plan(df) and "hashpartitioning" not in plan(df)


def test_more_blocks_than_are_broadcast(spark, folder, small_blocks, monkeypatch):
    monkeypatch.setattr(places, "BROADCAST_BLOCKS", 2)
    df = pairloom.load(spark, "json", split="train", data_files=folder)
    assert sorted((r.id, r.k) for r in df.collect()) == [(i, i) for i in range(300)]


def test_blocks_that_moved_are_an_error(spark, folder, small_blocks):
    df = pairloom.load(spark, "json", split="train", data_files=folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    with pytest.raises(Exception, match="cut into other blocks"):
        df.collect()


def test_slices_of_parquet_read_only_their_files(spark, tmp_path):
    for f in range(12):
        spark.range(f * 10, f * 10 + 10, numPartitions=1).selectExpr("id AS k", "struct('a' AS de, 'b' AS en) AS translation").write.parquet(f"{tmp_path}/train/n={f}")
    load = lambda split, **more: pairloom.load(spark, str(tmp_path), split=split, **more)
    want = [*range(15, 25), *range(117, 120)]
    df = load("train[15:25]+train[-3:]")
    assert sorted((r.id, r.k) for r in df.collect()) == list(enumerate(want))
    assert "hashpartitioning" not in plan(df)
    # The scan behind the plan has three of the twelve files.
    scans = df._jdf.queryExecution().executedPlan().collectLeaves()
    numbers = [scans.apply(i).metrics().get("numFiles") for i in range(scans.size())]
    assert df.count() == len(want) and files_read(load("train[:15]"), spark) == 2
    assert numbers
    assert sorted(r.k for r in load("train", max_examples=23).collect()) == list(range(23))
    for named in (1, 100):
        places.FILES_NAMED, before = named, places.FILES_NAMED
        try:
            assert sorted(r.k for r in load("train[5:9]+train[90:92]+train[31:33]").collect()) == [5, 6, 7, 8, 31, 32, 90, 91]
        finally:
            places.FILES_NAMED = before


def test_several_splits(spark, tmp_path):
    for name, begin in (("train", 0), ("test", 100)):
        spark.range(begin, begin + 20, numPartitions=1).selectExpr("id AS k", "struct('a' AS de, 'b' AS en) AS translation").write.parquet(f"{tmp_path}/{name}")
    df = pairloom.load(spark, str(tmp_path), split="test+train[50%:]", max_examples=25)
    assert sorted((r.id, r.k) for r in df.collect()) == list(enumerate([*range(100, 120), *range(10, 15)]))
    both = pairloom.load(spark, str(tmp_path), split="train+test", include_ids=False)
    assert sorted(r.k for r in both.collect()) == [*range(20), *range(100, 120)]
    ordered = pairloom.load(spark, str(tmp_path), split="train+test", order_by=[F.desc("k")], max_examples=3)
    assert sorted((r.id, r.k) for r in ordered.collect()) == [(0, 119), (1, 118), (2, 117)]
    with pytest.raises(ValueError, match="file order"):
        pairloom.load(spark, str(tmp_path), split="train[:5]", order_by=["k"])


def test_split_expressions():
    assert [part.rows(7) for part in parse_split("a[:50%]+b[-3:]+c[2:99]+a")] == [(0, 4), (4, 7), (2, 7), (0, 7)]
    for bad in ("a[", "a[1]", "a]+b", "", "a[x:]"):
        with pytest.raises(ValueError, match="split expression"):
            parse_split(bad)
    with pytest.raises(ValueError, match="beyond"):
        parse_split("a[:120%]")[0].rows(5)
    assert sorted(["part-100000", "part-20000", "b/2", "b/10", "b"], key=natural) == ["b", "b/2", "b/10", "part-20000", "part-100000"]


def test_lines_have_numbers(spark, folder, small_blocks):
    rows = Source(spark, "text", [("", folder)], None).lines().where("value <> ''").collect()
    assert len(rows) == 300 and {json.loads(r.value)["k"] % 100 for r in rows if r.line == 199} == {99}
    assert all(r.line == 2 * (json.loads(r.value)["k"] % 100) + 1 for r in rows)


def test_a_bad_record_is_named_by_file_and_line(spark, tmp_path, small_blocks):
    good = "\n".join(json.dumps({"de": "x" * 30, "n": i}) for i in range(100))
    for name in ("a.jsonl", "b.jsonl"):
        (tmp_path / "x.jsonl").mkdir(exist_ok=True)
        (tmp_path / "x.jsonl" / name).write_text(good + ("\n\n{\"de\": 1, \n" if name == "b.jsonl" else "\n"), "utf-8")
    path = str(tmp_path / "x.jsonl")
    for schema in ("de string, n long", None):
        with pytest.raises(Exception, match=r"b\.jsonl, line 102: no record: \{"):
            read_records(spark, path, schema, locate=True).collect()
    (tmp_path / "x.jsonl" / "b.jsonl").write_text(good + "\n\n", "utf-8")
    assert read_records(spark, path, "de string, n long", locate=True).count() == 200
    assert read_records(spark, path, locate=True).columns == ["de", "n"]


def test_report_with_characters_beyond_the_first_plane(spark, tmp_path):
    texts = ["\U000e0001", "a\U0001d173b'\U000e0001", "\\U0001f600", "😀", "\\\U000e0001\"'", " \x01\xad"]
    (tmp_path / "r.txt").write_text("\n".join(repr({"seq_no": k, "text": t}) for k, t in enumerate(texts)) + "\n", "utf-8")
    rows = read_report(spark, str(tmp_path / "r.txt"), "seq_no long, text string").collect()
    assert [r.text for r in sorted(rows, key=lambda r: r.seq_no)] == texts
