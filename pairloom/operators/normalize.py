"""Normalization of sentence pairs and its report."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.registry import resolve_changes
from pairloom.operators.boundary import stage_boundary
from pairloom.operators.labels import with_labels
from pairloom.schemas import LANGS


def norm(
    df: DataFrame,
    changes: Sequence | None = None,
    *,
    langs: Sequence[str] = LANGS,
    annotate: bool = False,
    debug: bool = False,
) -> DataFrame:
    """Apply the changes in the given order to each side of ``translation``.

    Null texts stay null. With ``annotate`` the result also has, per language, the
    array ``<lang>_norm_changes`` with the names of the changes that altered the
    text, and with ``debug`` the text before as ``<lang>_before``.
    """
    steps = resolve_changes(changes) or []
    out = df.withColumns({f"_{lang}_0": F.col(f"translation.{lang}") for lang in langs})
    altered: dict[str, list] = {lang: [] for lang in langs}
    # One projection per step: each text is computed once and then referred to by the
    # next step and by the comparison.
    for number, step in enumerate(steps, start=1):
        out = out.withColumns({f"_{lang}_{number}": step(F.col(f"_{lang}_{number - 1}")) for lang in langs})
        for lang in langs:
            same = F.col(f"_{lang}_{number}").eqNullSafe(F.col(f"_{lang}_{number - 1}"))
            altered[lang].append((step.name, ~same))

    translation = F.col("translation")
    for lang in langs:
        translation = translation.withField(lang, F.col(f"_{lang}_{len(steps)}"))
    columns = [translation.alias("translation") if name == "translation" else F.col(name) for name in df.columns]
    if annotate:
        out = with_labels(out, {f"{lang}_norm_changes": altered[lang] for lang in langs})
        columns += [F.col(f"{lang}_norm_changes") for lang in langs]
        if debug:
            columns += [F.col(f"_{lang}_0").alias(f"{lang}_before") for lang in langs]
    return out.select(columns)


def norm_report_row(
    langs: Sequence[str] = LANGS, id_field: str = "id", start_id: int = 0, debug: bool = False
) -> tuple[Column, list[Column]]:
    """Whether a row from ``norm(annotate=True)`` is in the report, and the report's columns."""
    changed = [F.size(f"{lang}_norm_changes") for lang in langs]
    columns = [(F.col(id_field) - start_id + 1).alias("seq_no"), *(F.col(f"{lang}_norm_changes") for lang in langs)]
    if debug:
        for lang in langs:
            columns += [F.col(f"{lang}_before"), F.col(f"translation.{lang}").alias(f"{lang}_after")]
    return sum(changed[1:], changed[0]) > 0, columns


def norm_report(
    annotated: DataFrame,
    *,
    langs: Sequence[str] = LANGS,
    id_field: str = "id",
    start_id: int = 0,
    debug: bool = False,
) -> DataFrame:
    """The rows that a change altered, from the result of ``norm(annotate=True)``.

    ``seq_no`` is the 1-based position among all rows, so it follows from the dense id.
    """
    altered, columns = norm_report_row(langs, id_field, start_id, debug)
    return stage_boundary(annotated).where(altered).select(*columns)
