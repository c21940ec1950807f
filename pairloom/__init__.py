"""Preparation of parallel corpora on Spark: load, norm, filter, tokenize, map, split."""

from pairloom.functions.registry import register_change, register_pair_predicate, register_predicate
from pairloom.operators.encode import tokenize
from pairloom.operators.flaws import filter_pairs as filter
from pairloom.operators.normalize import norm
from pairloom.operators.training import map_training as map
from pairloom.plans.preprocess import preprocess
from pairloom.sources.pairs import load_pairs as load
from pairloom.sources.sinks import write_splits as split

__all__ = [
    "filter",
    "load",
    "map",
    "norm",
    "preprocess",
    "register_change",
    "register_pair_predicate",
    "register_predicate",
    "split",
    "tokenize",
]
