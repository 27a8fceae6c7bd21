"""The training run: split, bins, WOE, L1 selection, final fit, rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from leadwright.functions import fixed_values as fx
from leadwright.operators import model as md
from leadwright.operators import scorecard as sc
from leadwright.operators import woe as wo
from leadwright.session import materialise


@dataclass(frozen=True)
class Trained:
    bins: DataFrame
    first_coefs: DataFrame
    coefs: DataFrame
    rules: DataFrame
    train_woe: DataFrame
    test_woe: DataFrame
    members: DataFrame | None = None


NOT_FEATURES = [*fx.ID_COLUMNS, *fx.NOT_BINNED, "alloc_time", "last_visit_time"]


def train_scorecard(
    rows: DataFrame,
    target: str = fx.TARGET,
    ids: list[str] = ("task_id",),
    breaks: dict[str, list] = fx.BREAKS,
    skip: list[str] = NOT_FEATURES,
    features: list[str] | None = None,
    min_iv: float = 0.0,
    C: float = fx.L1_C,
    test_from: str | None = None,
) -> Trained:
    """Bins of every column not skipped (manual where ``breaks`` names it), L1 fit over all of them, then the
    final fit on ``features`` (variable names) or, by default, on those with a non-zero coefficient.

    The test part is 30 % of each class, or with ``test_from`` the leads allocated from that day on.
    """
    if test_from is None:
        split = md.split_stratified(rows, list(ids), target)
    else:
        split = md.split_out_of_time(rows, "alloc_date", test_from)
    variables = [c for c in rows.columns if c not in skip and c != target and c not in ids]
    split = materialise(split.select(*ids, target, *variables, "part"), "split")
    train, test = (split.where(F.col("part") == part).drop("part") for part in ("train", "test"))
    texts = [c for c, kind in train.dtypes if kind in ("string", "boolean") and c in variables and c not in breaks]
    members = wo.categories_by_rate(train, target, texts) if texts else None
    bins = materialise(wo.fit_bins(train, target, breaks, skip=list(ids), members=members), "bins")
    if min_iv > 0:
        bins = bins.join(wo.information_value(bins, min_iv).select("variable"), "variable", "left_semi")
    train_woe = materialise(wo.apply_woe(train, bins, [*ids, target], members), "train_woe")
    test_woe = wo.apply_woe(test, bins, [*ids, target], members)
    names = [c for c in train_woe.columns if c.endswith("_woe")]
    _, first = md.fit_l1(train_woe, names, target, C)
    chosen = [f"{v}_woe" for v in features] if features else md.select_nonzero(first)
    _, final = md.fit_l1(train_woe, chosen, target, C) if chosen else (None, first)
    return Trained(bins, first, final, sc.scorecard(bins, final), train_woe, test_woe, members)
