"""Operators addressable by name: text changes, text predicates, pair predicates.

A configuration entry is ``"name"`` or ``["name", {option: value}]``. Users add their
own with the ``register_*`` functions; a registered function takes and returns
columns, so a pandas UDF serves as well as a built-in expression.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pairloom.functions import changes, pair_predicates, predicates

CHANGES: dict[str, Callable] = {
    f.__name__: f
    for f in (
        changes.strip_edges,
        changes.remove_control_chars,
        changes.collapse_whitespace,
        changes.normalize_unicode_quotes,
        changes.fix_apostrophe_spacing,
    )
}
PREDICATES: dict[str, Callable] = {
    f.__name__: f
    for f in (
        predicates.is_too_short,
        predicates.is_too_long,
        predicates.is_blank,
        predicates.contains_german_chars,
        predicates.contains_email,
        predicates.contains_control_chars,
        predicates.contains_invisible_format_chars,
        predicates.contains_url,
        predicates.has_odd_number_of_quotes,
        predicates.has_unbalanced_brackets,
        predicates.target_not_latin_like,
    )
}
PAIR_PREDICATES: dict[str, Callable] = {
    f.__name__: f
    for f in (
        pair_predicates.bad_length_ratio,
        pair_predicates.reject_with_probability,
        pair_predicates.are_equal,
    )
}
# Pair predicates that look at the id of the row.
BY_ID = {"reject_with_probability"}
# Tests that only look at lengths; a short-circuiting filter runs them first.
CHEAP = {"is_too_short", "is_too_long", "bad_length_ratio"}


@dataclass(frozen=True)
class Step:
    """One configured operator: calling it applies the function with its options."""

    name: str
    function: Callable
    options: dict[str, Any] = field(default_factory=dict)
    # Arguments that the run adds and the label doesn't show.
    context: dict[str, Any] = field(default_factory=dict)

    @property
    def label(self) -> str:
        if not self.options:
            return self.name
        shown = ", ".join(f"{key}={value!r}" for key, value in self.options.items())
        return f"{self.name}({shown})"

    def __call__(self, *columns):
        return self.function(*columns, **{**self.context, **self.options})


def register_change(name: str, function: Callable) -> None:
    CHANGES[name] = function


def register_predicate(name: str, function: Callable) -> None:
    PREDICATES[name] = function


def register_pair_predicate(name: str, function: Callable) -> None:
    PAIR_PREDICATES[name] = function


def _step(entry, table: dict[str, Callable], kind: str) -> Step:
    match entry:
        case Step():
            return entry
        case str(name):
            options = {}
        case [str(name), dict(options)]:
            pass
        case _:
            raise ValueError(f"a {kind} is a name or [name, options], not {entry!r}")
    if name not in table:
        raise ValueError(f"there is no {kind} called {name!r}")
    return Step(name, table[name], options)


def _steps(entries: Sequence | None, table: dict[str, Callable], kind: str) -> list[Step] | None:
    return None if entries is None else [_step(entry, table, kind) for entry in entries]


def resolve_changes(entries: Sequence | None) -> list[Step] | None:
    return _steps(entries, CHANGES, "change")


def resolve_predicates(entries: Sequence | None) -> list[Step] | None:
    return _steps(entries, PREDICATES, "predicate")


def resolve_pair_predicates(entries: Sequence | None, id_field: str | None = None) -> list[Step] | None:
    """``id_field`` is what predicates that draw by the id use, if their options name no column."""
    steps = _steps(entries, PAIR_PREDICATES, "predicate")
    if steps is None or id_field is None:
        return steps
    return [replace(s, context={"id_col": id_field}) if s.name in BY_ID else s for s in steps]
