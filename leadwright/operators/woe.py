"""Weight-of-evidence binning: manual and automatic bins, WOE and IV, and their application.

Rows are counted per (variable, bin) in one pass for all variables, folded on the map side. Only the
bin table, a few rows per variable, is ever handled as a whole.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from leadwright.operators.ordered import running_sums
from leadwright.session import materialise

# The split search runs in Python workers; sent by value, it needs no installed package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MISSING = "missing"
# Count put in place of an empty positive or negative cell, so that every WOE is finite.
EMPTY_CELL = 0.9
MAX_BINS_TOTAL = 10_000
#: Categories that the bins of one variable may name.
MAX_LISTED = 10_000

BIN_FIELDS = (
    "variable string, bin_id int, bin string, kind string, lo double, hi double, categories array<string>"
)


@dataclass(frozen=True)
class Bin:
    variable: str
    bin_id: int
    label: str
    kind: str  # missing, interval, category or cells (an interval of cell numbers)
    lo: float | None = None
    hi: float | None = None
    categories: tuple[str, ...] | None = None

    def row(self) -> tuple:
        return (self.variable, self.bin_id, self.label, self.kind, self.lo, self.hi,
                list(self.categories) if self.categories else None)

    def test(self) -> Column:
        col = F.col(self.variable)
        if self.kind == "missing":
            return col.isNull()
        if self.kind == "category":
            return col.isin(list(self.categories))
        tests = ([col >= self.lo] if self.lo is not None else []) + ([col < self.hi] if self.hi is not None else [])
        if not tests:
            return col.isNotNull()
        return tests[0] if len(tests) == 1 else tests[0] & tests[1]


def interval_label(lo: float | None, hi: float | None) -> str:
    return f"[{_number(lo, '-inf')},{_number(hi, 'inf')})"


def _number(x: float | None, none: str) -> str:
    """Short where six digits say it all, else in full, so that different limits have different labels."""
    if x is None:
        return none
    return f"{x:g}" if float(f"{x:g}") == x else repr(float(x))


def bins_from_breaks(breaks: dict[str, list]) -> list[Bin]:
    """Bins of a break list: numbers are left-closed interval limits, texts are one bin each. NULL always
    has its own bin, which disappears from the bin table when no row falls into it."""
    bins = []
    for variable, marks in breaks.items():
        bins.append(Bin(variable, 0, MISSING, "missing"))
        values = [m for m in marks if m != MISSING]
        if any(isinstance(v, str) for v in values):
            bins += [Bin(variable, i + 1, v, "category", categories=(v,)) for i, v in enumerate(values)]
        else:
            edges = [None, *[float(v) for v in values], None]
            bins += [Bin(variable, i + 1, interval_label(lo, hi), "interval", lo, hi)
                     for i, (lo, hi) in enumerate(zip(edges, edges[1:]))]
    return bins


def bins_frame(spark: SparkSession, bins: list[Bin]) -> DataFrame:
    return spark.createDataFrame([b.row() for b in bins], BIN_FIELDS)


def collect_bins(bins: DataFrame, value: str) -> tuple[list[Bin], dict[tuple[str, int], float]]:
    """The bins and one value per bin, in a single job; the size of the table is checked."""
    fields = ["variable", "bin_id", "bin", "kind", "lo", "hi", "categories", value]
    rows = bins.select(*fields).limit(MAX_BINS_TOTAL + 1).collect()
    if len(rows) > MAX_BINS_TOTAL:
        raise ValueError(f"more than {MAX_BINS_TOTAL} bins")
    rows.sort(key=lambda r: (r.variable, r.bin_id))
    found = [Bin(r.variable, r.bin_id, r.bin, r.kind, r.lo, r.hi, tuple(r.categories) if r.categories else None) for r in rows]
    return found, {(r.variable, r.bin_id): r[value] for r in rows}


def by_variable(bins: list[Bin]) -> dict[str, list[Bin]]:
    out: dict[str, list[Bin]] = {}
    for b in bins:
        out.setdefault(b.variable, []).append(b)
    return out


def pick(bins: list[Bin], values: list, default=None) -> Column:
    """The value of the bin a row falls into."""
    chain = F
    for b, value in zip(bins, values):
        chain = chain.when(b.test(), F.lit(value))
    return chain.otherwise(F.lit(default))


def bin_counts(df: DataFrame, bins: list[Bin], target: str) -> DataFrame:
    """Rows, positives and negatives per variable and bin; one pass over ``df`` for all variables."""
    # Variables go by their number, so that no text is copied or hashed per row and variable.
    variables = by_variable(bins)
    cells = F.array(*[pick(bs, [b.bin_id for b in bs]).cast("int") for bs in variables.values()])
    known = df.where(F.col(target).isNotNull())
    long = known.select(F.col(target).alias("_y"), F.posexplode(cells).alias("_v", "bin_id"))
    numbered = long.where(F.col("bin_id").isNotNull()).groupBy("_v", "bin_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").cast("bigint").alias("pos")
    )
    names = F.array(*[F.lit(v) for v in variables])
    counts = numbered.select(names[F.col("_v")].alias("variable"), "bin_id", "n", "pos")
    # The definitions are made on the driver and counted, so the broadcast is bounded.
    if len(bins) > MAX_BINS_TOTAL:
        raise ValueError(f"more than {MAX_BINS_TOTAL} bins")
    defs = F.broadcast(bins_frame(df.sparkSession, bins))
    return counts.join(defs, ["variable", "bin_id"]).withColumn("neg", F.col("n") - F.col("pos"))


def woe_table(counts: DataFrame, empty_cell: float = EMPTY_CELL) -> DataFrame:
    """Add ``woe`` = ln(share of positives / share of negatives) and ``bin_iv`` to a count table."""
    whole = Window.partitionBy("variable")  # a few rows per variable
    def share(c: str) -> Column:
        filled = F.when(F.col(c) == 0, F.lit(empty_cell)).otherwise(F.col(c).cast("double"))
        return filled / F.sum(filled).over(whole)
    shares = counts.withColumns({"_p": share("pos"), "_q": share("neg")})
    woe = shares.withColumn("woe", F.log(F.col("_p") / F.col("_q")))
    return woe.withColumn("bin_iv", (F.col("_p") - F.col("_q")) * F.col("woe")).drop("_p", "_q")


def information_value(bins: DataFrame, threshold: float = 0.0) -> DataFrame:
    ivs = bins.groupBy("variable").agg(F.sum("bin_iv").alias("iv"), F.count(F.lit(1)).alias("n_bins"))
    return ivs.where(F.col("iv") >= threshold)


def monotonicity(bins: DataFrame, value: Column | None = None) -> DataFrame:
    """Per variable with intervals: how often the WOE (or ``value``) turns between neighbouring intervals."""
    value = F.col("woe") if value is None else value
    order = Window.partitionBy("variable").orderBy("bin_id")  # a few rows per variable
    steps = bins.where(F.col("kind") == "interval").withColumn("step", F.signum(value - F.lag(value).over(order)))
    turns = steps.withColumn("turn", F.col("step") * F.lag("step").over(order) < 0)
    return turns.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n_bins"), F.sum(F.when(F.col("turn"), 1).otherwise(0)).alias("turns")
    ).withColumn("monotone", F.col("turns") == 0)


def apply_woe(df: DataFrame, bins: DataFrame, keep: list[str], members: DataFrame | None = None) -> DataFrame:
    """Replace each binned variable by ``<variable>_woe``: one projection, no join and no shuffle. A value outside all bins
    gets 0. Variables binned by cells are turned into cell numbers first, by a join with ``members``."""
    found, woe = collect_bins(bins, "woe")
    wide = sorted({b.variable for b in found if b.kind == "cells"})
    if wide and members is None:
        raise ValueError(f"the bins of {wide} are told by cells: the table of their categories is needed")
    df = with_cells(df, members, wide) if wide else df
    columns = [
        pick(bs, [woe[v, b.bin_id] for b in bs], 0.0).alias(f"{v}_woe") for v, bs in by_variable(found).items()
    ]
    return df.select(*keep, *columns)


# ---------------------------------------------------------------- automatic bins
def categories_by_rate(df: DataFrame, target: str, variables: list[str], n_fine: int = 50) -> DataFrame:
    """variable, category, cell, n, pos: the categories of each text variable in the order of their rate, in cells.

    One cell each where they are few, else ``n_fine`` cells of like weight. The table has a row per category, however many there
    are; it is written, and read only by joins on (variable, category) and (variable, cell).
    """
    cells = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("string").alias("category")) for v in variables])
    long = df.where(F.col(target).isNotNull()).select(F.col(target).alias("_y"), F.explode(cells).alias("_c"))
    counts = long.where(F.col("_c.category").isNotNull()).groupBy("_c.variable", "_c.category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").cast("bigint").alias("pos"))
    rated = counts.withColumns({"rate": F.col("pos") / F.col("n"), "one": F.lit(1)})
    placed = running_sums(rated, ["variable"], ["rate", "category"], {"n": "n", "one": "one"})
    by_weight = F.floor((F.col("cum_n") - F.col("n") / 2) * n_fine / F.col("total_n"))
    place = F.when(F.col("total_one") <= n_fine, F.col("cum_one") - 1).otherwise(F.least(by_weight, F.lit(n_fine - 1)))
    return materialise(placed.select("variable", "category", place.cast("int").alias("cell"), "n", "pos"), "categories")


def with_cells(df: DataFrame, members: DataFrame, variables: list[str]) -> DataFrame:
    """Each of the text variables replaced by the number of its category's cell; -1 for a category that was not seen."""
    for v in variables:
        own = members.where(F.col("variable") == v).select(F.col("category").alias("_category"), F.col("cell").alias("_cell"))
        met = df.join(own, F.col(v).cast("string") == F.col("_category"), "left")
        df = met.withColumn(v, F.when(F.col(v).isNotNull(), F.coalesce("_cell", F.lit(-1)))).drop("_category", "_cell")
    return df


def in_cells(bins: DataFrame) -> list[str]:
    """Variables whose bins are told by cell numbers, as they have more than ``MAX_LISTED`` categories; a row per variable is collected."""
    return sorted(r.variable for r in bins.where(F.col("kind") == "cells").select("variable").distinct().collect())


def _fine_edges(df: DataFrame, numeric: list[str], n_fine: int) -> dict[str, list[float]]:
    """Limits between the fine cells of each number: every value a cell of its own where they are few, else quantiles."""
    doubles = df.select(*[F.col(v).cast("double").alias(v) for v in numeric])
    # Sketches of 4,096 registers (2 %), kept as one binary buffer a column. They only choose whose values are looked at.
    sizes = doubles.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(F.when(F.col(v).isNotNull(), F.xxhash64(v)), 12)).alias(v) for v in numeric]).first()
    edges, few = {}, [v for v in numeric if (sizes[v] or 0) <= 2 * n_fine]
    if few:
        pairs = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("value")) for v in few])
        # About 2 n_fine values of each variable at most.
        found = doubles.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull()).distinct().collect()
        values = {v: sorted(r.value for r in found if r.variable == v) for v in few}
        edges = {v: x[1:] for v, x in values.items() if len(x) <= n_fine}
    rest = [v for v in numeric if v not in edges]
    if rest:
        # Sketches are merged in a tree, not in one task; their error is a twentieth of a cell.
        sketched = doubles.approxQuantile(rest, [i / n_fine for i in range(1, n_fine)], 1 / (20 * n_fine))
        edges |= {v: sorted(set(e)) for v, e in zip(rest, sketched)}
    return edges


def _fine_counts(df: DataFrame, variables: dict[str, str], target: str, n_fine: int, members: DataFrame | None) -> DataFrame:
    """variable, kind, edges, listed and per fine cell n and pos: a few rows per variable, whatever the number of categories."""
    numeric = [v for v, kind in variables.items() if kind == "interval"]
    texts = [v for v in variables if v not in numeric]
    edges = _fine_edges(df, numeric, n_fine) if numeric else {}

    def cell(v: str) -> Column:
        if v in texts:  # only the rows without a value are counted here
            return F.lit(None).cast("int")
        limits = F.array(*[F.lit(e) for e in edges[v]]) if edges[v] else F.array().cast("array<double>")
        return F.when(F.col(v).isNotNull(), F.size(F.filter(limits, lambda e: e <= F.col(v).cast("double"))))

    wanted = [F.struct(F.lit(v).alias("variable"), cell(v).alias("cell"), (F.lit(v in numeric) | F.col(v).isNull()).alias("here")) for v in variables]
    long = df.where(F.col(target).isNotNull()).select(F.col(target).alias("_y"), F.explode(F.array(*wanted)).alias("_c")).where("_c.here")
    counts = long.groupBy("_c.variable", "_c.cell").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").cast("bigint").alias("pos"))
    listed = {v: None for v in numeric}
    if texts:
        of_texts = members.where(F.col("variable").isin(texts))
        counts = counts.unionByName(of_texts.groupBy("variable", "cell").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")))
        sizes = {r["variable"]: r["m"] for r in of_texts.groupBy("variable").agg(F.count(F.lit(1)).alias("m")).collect()}
        listed |= {v: sizes.get(v, 0) <= MAX_LISTED for v in texts}
    limits = df.sparkSession.createDataFrame(
        [(v, k, edges.get(v, []), listed[v]) for v, k in variables.items()], "variable string, kind string, edges array<double>, listed boolean")
    return counts.join(F.broadcast(limits), "variable")


def _iv(pos: np.ndarray, neg: np.ndarray) -> float:
    p = np.where(pos == 0, EMPTY_CELL, pos)
    q = np.where(neg == 0, EMPTY_CELL, neg)
    p, q = p / p.sum(), q / q.sum()
    return float(((p - q) * np.log(p / q)).sum())


def best_splits(n: np.ndarray, pos: np.ndarray, max_bins: int, min_share: float, min_gain: float) -> list[int]:
    """Greedy split points of ordered fine cells: each step takes the split with the greatest IV."""
    cuts: list[int] = []
    iv, floor = 0.0, min_share * n.sum()
    while len(cuts) + 1 < max_bins:
        best = (iv, None)
        for c in range(1, len(n)):
            trial = sorted({*cuts, c})
            if len(trial) == len(cuts):
                continue
            sums = np.add.reduceat(n, [0, *trial])
            if sums.min() < floor:
                continue
            # Rounded, so that ties go to the lower split whatever the order of the sums.
            gained = round(_iv(np.add.reduceat(pos, [0, *trial]), np.add.reduceat(n - pos, [0, *trial])), 9)
            if gained > best[0]:
                best = (gained, c)
        if best[1] is None or (iv > 0 and best[0] / iv - 1 < min_gain):
            break
        iv, cuts = best[0], sorted([*cuts, best[1]])
    return cuts


def auto_bins(
    df: DataFrame,
    target: str,
    variables: list[str],
    max_bins: int = 8,
    min_share: float = 0.05,
    min_gain: float = 0.1,
    n_fine: int = 50,
    members: DataFrame | None = None,
) -> DataFrame:
    """Supervised bins of each variable as a WOE table.

    Spark counts the rows per fine cell; the splits are then sought per variable in its table of at most ``n_fine`` cells. The bins of
    a text variable are runs of cells of ``members`` (made here where it is not given). A bin lists its categories where the variable
    has at most ``MAX_LISTED``; otherwise its kind is ``cells``, and ``with_cells`` turns the variable into cell numbers.
    """
    kinds = {f.name: "category" if isinstance(f.dataType, (T.StringType, T.BooleanType)) else "interval"
             for f in df.schema if f.name in variables}
    texts = [v for v, kind in kinds.items() if kind == "category"]
    if texts and members is None:
        members = categories_by_rate(df, target, texts, n_fine)

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        variable, kind = pdf["variable"].iloc[0], pdf["kind"].iloc[0]
        missing, cells = pdf[pdf["cell"].isna()], pdf[pdf["cell"].notna()].sort_values("cell")
        out = []
        if len(missing):
            out.append((variable, 0, MISSING, "missing", None, None, int(missing["n"].sum()), int(missing["pos"].sum())))
        if len(cells):
            n, pos, numbers = cells["n"].to_numpy(float), cells["pos"].to_numpy(float), cells["cell"].to_numpy(int)
            starts = [0, *best_splits(n, pos, max_bins, min_share, min_gain)]
            edges = list(pdf["edges"].iloc[0])
            for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(cells)])):
                if kind == "category":
                    lo, hi = float(numbers[a]) if a else 0.0, float(numbers[b]) if b < len(cells) else float(n_fine)
                    found, label = "category" if pdf["listed"].iloc[0] else "cells", f"cells {interval_label(lo, hi)}"
                else:
                    lo = float(edges[numbers[a] - 1]) if a else None
                    hi = float(edges[numbers[b] - 1]) if b < len(cells) else None
                    found, label = kind, interval_label(lo, hi)
                out.append((variable, i + 1, label, found, lo, hi, int(n[a:b].sum()), int(pos[a:b].sum())))
        names = ["variable", "bin_id", "bin", "kind", "lo", "hi", "n", "pos"]
        return pd.DataFrame(out, columns=names).astype({"lo": float, "hi": float})

    fine = _fine_counts(df, kinds, target, n_fine, members)
    merged = fine.groupBy("variable").applyInPandas(
        split, "variable string, bin_id int, bin string, kind string, lo double, hi double, n bigint, pos bigint")
    merged = merged.withColumns({c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c in ("lo", "hi")})
    none = F.lit(None).cast("array<string>")
    if texts:
        # At most MAX_LISTED names per variable come together.
        cells = merged.where(F.col("kind") == "category").select(
            "variable", "bin_id", F.explode(F.sequence(F.col("lo").cast("int"), F.col("hi").cast("int") - 1)).alias("cell"))
        names = members.join(cells, ["variable", "cell"]).groupBy("variable", "bin_id").agg(F.sort_array(F.collect_list("category")).alias("categories"))
        merged = merged.join(names, ["variable", "bin_id"], "left")
        merged = merged.withColumns({
            "bin": F.when(F.col("kind") == "category", F.array_join("categories", "|")).otherwise(F.col("bin")),
            **{c: F.when(F.col("kind") != "category", F.col(c)) for c in ("lo", "hi")}})
    else:
        merged = merged.withColumn("categories", none)
    merged = merged.select(*[f.split()[0] for f in BIN_FIELDS.split(", ")], "n", "pos")
    return woe_table(merged.withColumn("neg", F.col("n") - F.col("pos")))


def monotone_bins(bins: DataFrame) -> DataFrame:
    """The bins with neighbouring intervals pooled until the rate of positives of each variable only rises or only falls, and the
    WOE with it, but for the count put in place of an empty cell where cells hold one or two rows.

    Pool adjacent violators, in whole numbers; intervals of equal rate are pooled too. Of the two
    directions the one with the smaller squared error (rows times distance of rate and fit) is taken, the rising one at a tie. Bins that are
    no intervals stay as they are.
    """
    def pooled(rows: pd.DataFrame, sign: int) -> list[list[int]]:
        blocks: list[list[int]] = []  # first, last, n, pos
        for i, (n, pos) in enumerate(zip(rows["n"], rows["pos"])):
            blocks.append([i, i, int(n), int(pos)])
            while len(blocks) > 1 and sign * (blocks[-2][3] * blocks[-1][2] - blocks[-1][3] * blocks[-2][2]) >= 0:
                _, last, n2, pos2 = blocks.pop()
                first, _, n1, pos1 = blocks.pop()
                blocks.append([first, last, n1 + n2, pos1 + pos2])
        return blocks

    def error(rows: pd.DataFrame, blocks: list[list[int]]) -> float:
        out = 0.0
        for first, last, n, pos in blocks:
            part = rows.iloc[first:last + 1]
            out += float((part["n"] * (part["pos"] / part["n"] - pos / n) ** 2).sum())
        return round(out, 9)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, rest = pdf[pdf["kind"] == "interval"].sort_values("bin_id"), pdf[pdf["kind"] != "interval"]
        out = [r for r in rest.itertuples(index=False, name=None)]
        if len(rows):
            blocks = min((pooled(rows, sign) for sign in (1, -1)), key=lambda b: error(rows, b))
            finite = lambda x: None if x is None or x != x else float(x)
            for i, (first, last, n, pos) in enumerate(blocks):
                lo, hi = finite(rows["lo"].iloc[first]), finite(rows["hi"].iloc[last])
                out.append((pdf["variable"].iloc[0], i + 1, interval_label(lo, hi), "interval", lo, hi, None, n, pos))
        return pd.DataFrame(out, columns=[f.split()[0] for f in BIN_FIELDS.split(", ")] + ["n", "pos"]).astype({"lo": float, "hi": float})

    fields = [f.split()[0] for f in BIN_FIELDS.split(", ")]
    found = bins.select(*fields, "n", "pos").groupBy("variable").applyInPandas(merge, BIN_FIELDS + ", n bigint, pos bigint")
    finite = {c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c in ("lo", "hi")}
    return woe_table(found.withColumns(finite).withColumn("neg", F.col("n") - F.col("pos")))


def fit_bins(
    df: DataFrame, target: str, breaks: dict[str, list] | None = None, skip: list[str] = (), **auto
) -> DataFrame:
    """Bin table of every column but ``target`` and ``skip``: manual where ``breaks`` names it, else automatic."""
    wanted = [c for c in df.columns if c != target and c not in skip]
    breaks = {v: b for v, b in (breaks or {}).items() if v in wanted}
    rest = [v for v in wanted if v not in breaks]
    parts = []
    if breaks:
        parts.append(woe_table(bin_counts(df, bins_from_breaks(breaks), target)))
    if rest:
        parts.append(auto_bins(df, target, rest, **auto))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
