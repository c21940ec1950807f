import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairloom.functions import registry as r
from pairloom.operators.flaws import filter_pairs, find_flaws
from pairloom.operators.normalize import norm


def test_entries_become_labelled_steps():
    steps = r.resolve_predicates(["is_blank", ["is_too_short", {"min": 10}], ("is_blank", {})])
    assert [s.label for s in steps] == ["is_blank", "is_too_short(min=10)", "is_blank"]
    (ratio,) = r.resolve_pair_predicates([["bad_length_ratio", {"min": 0.33, "max": 3}]])
    assert ratio.label == "bad_length_ratio(min=0.33, max=3)"
    (control,) = r.resolve_predicates([["contains_control_chars", {"allow": "\t"}]])
    assert control.label == "contains_control_chars(allow='\\t')"


def test_none_stays_none():
    assert r.resolve_changes(None) is None
    assert r.resolve_predicates([]) == []


@pytest.mark.parametrize("entry", ["does_not_exist", ["re", {}], ["F", {}]])
def test_unknown_names(entry):
    with pytest.raises(ValueError, match="no predicate called"):
        r.resolve_predicates([entry])
    with pytest.raises(ValueError, match="no change called"):
        r.resolve_changes([entry])


@pytest.mark.parametrize("entry", [3, ["is_blank"], ["is_blank", 1], [1, {}], None])
def test_malformed_entries(entry):
    with pytest.raises(ValueError, match="a predicate is a name"):
        r.resolve_predicates([entry])


def test_own_operators(make_pairs, monkeypatch):
    for table in ("CHANGES", "PREDICATES", "PAIR_PREDICATES"):
        monkeypatch.setattr(r, table, dict(getattr(r, table)))

    @F.pandas_udf("boolean")
    def shouts(texts: pd.Series) -> pd.Series:
        return texts.str.isupper()

    r.register_change("lower", lambda text: F.lower(text))
    r.register_predicate("shouts", shouts)
    r.register_pair_predicate("shares_start", lambda a, b, n: a.substr(1, n) == b.substr(1, n))
    rows = make_pairs([("HALLO", "hi"), ("ab", "ac"), ("xy", "zz")])
    flaws = find_flaws(rows, ["shouts"], [["shares_start", {"n": 1}]]).orderBy("id").collect()
    assert [(f["de_flaws"], f["en_flaws"], f["pair_flaws"]) for f in flaws] == [
        (["shouts"], [], []),
        ([], [], ["shares_start(n=1)"]),
        ([], [], []),
    ]
    assert [f["id"] for f in filter_pairs(rows, ["shouts"], [["shares_start", {"n": 1}]]).collect()] == [2]
    assert norm(rows, ["lower"]).orderBy("id").first()["translation"]["de"] == "hallo"
