"""Flaws of sentence pairs: finding, dropping and reporting them."""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.registry import CHEAP, Step, resolve_pair_predicates, resolve_predicates
from pairloom.operators.boundary import stage_boundary
from pairloom.operators.labels import with_labels
from pairloom.schemas import LANGS


def _text(lang: str) -> Column:
    return F.coalesce(F.col(f"translation.{lang}"), F.lit(""))


def find_flaws(
    df: DataFrame,
    predicates: Sequence | None = None,
    pair_predicates: Sequence | None = None,
    *,
    langs: Sequence[str] = LANGS,
    id_field: str = "id",
) -> DataFrame:
    """Add the labels of all flaws: ``<lang>_flaws`` per side and ``pair_flaws``.

    Every predicate is evaluated; the labels stand in the configured order.
    """
    tests = resolve_predicates(predicates) or []
    pair_tests = resolve_pair_predicates(pair_predicates, id_field) or []
    texts = {lang: _text(lang) for lang in langs}
    flaws = {f"{lang}_flaws": [(test.label, test(text)) for test in tests] for lang, text in texts.items()}
    flaws["pair_flaws"] = [(test.label, test(*texts.values())) for test in pair_tests]
    return with_labels(stage_boundary(df), flaws)


def filter_pairs(
    df: DataFrame,
    predicates: Sequence | None = None,
    pair_predicates: Sequence | None = None,
    *,
    langs: Sequence[str] = LANGS,
    id_field: str = "id",
) -> DataFrame:
    """Keep the pairs without any flaw.

    No labels are built: a pair is dropped at its first flaw, and the tests that only
    compare lengths come first, then the rest in the configured order.
    """
    both = [_text(lang) for lang in langs]
    tests: list[tuple[Step, list[Column]]] = [
        (t, [text]) for t in resolve_predicates(predicates) or [] for text in both
    ]
    tests += [(t, both) for t in resolve_pair_predicates(pair_predicates, id_field) or []]
    tests.sort(key=lambda test: test[0].name not in CHEAP)
    # A verdict that is null is none, as in find_flaws.
    flawed = [F.coalesce(test(*texts), F.lit(False)) for test, texts in tests]
    return stage_boundary(df).where(~reduce(or_, flawed)) if flawed else df


def flaw_count(langs: Sequence[str] = LANGS) -> Column:
    """Number of flaws of a row, from the label columns."""
    return F.size("pair_flaws") + sum((F.size(f"{lang}_flaws") for lang in langs), F.lit(0))


def keep(annotated: DataFrame, *, langs: Sequence[str] = LANGS) -> DataFrame:
    """The pairs without a flaw, from the result of ``find_flaws``."""
    labels = [*(f"{lang}_flaws" for lang in langs), "pair_flaws"]
    return stage_boundary(annotated).where(flaw_count(langs) == 0).drop(*labels)


def flaw_report_columns(langs: Sequence[str] = LANGS, id_field: str = "id", start_id: int = 0) -> list[Column]:
    """The columns of the report, whose rows have a flaw."""
    labels = [F.col(f"{lang}_flaws") for lang in langs]
    return [(F.col(id_field) - start_id + 1).alias("seq_no"), *labels, F.col("pair_flaws")]


def flaw_report(
    annotated: DataFrame, *, langs: Sequence[str] = LANGS, id_field: str = "id", start_id: int = 0
) -> DataFrame:
    """The flawed pairs with their labels, from the result of ``find_flaws``.

    ``seq_no`` is the 1-based position among all rows, so it follows from the dense id.
    """
    flawed = stage_boundary(annotated).where(flaw_count(langs) > 0)
    return flawed.select(*flaw_report_columns(langs, id_field, start_id))
