"""Exact quantiles of groups by selection: rounds of histograms narrow a bracket around each rank, and no task holds a group."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Bracket:
    """Values of a group from low to high, both values of the group: `n` of them, with `below` smaller ones; and the ranks (from 0,
    in the group) that lie among them."""

    group: tuple
    low: float
    high: float
    below: int
    n: int
    ranks: set[int] = field(default_factory=set)


def _inside(values: DataFrame, by: list[str], brackets: list[Bracket]) -> DataFrame:
    """Rows of values with the number (_b), low and high of the brackets that hold them."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in values.select(*by).dtypes)
    rows = [(*b.group, i, b.low, b.high) for i, b in enumerate(brackets)]
    table = values.sparkSession.createDataFrame(rows, f"{kinds}{', ' if by else ''}_b int, _low double, _high double")  # a few rows a group
    match = F.lit(True)
    for c in by:
        match = match & values[c].eqNullSafe(table[c])
    return values.join(F.broadcast(table), match & (F.col("_x") >= F.col("_low")) & (F.col("_x") <= F.col("_high"))).select("_b", "_low", "_high", "_x")


def quantiles(df: DataFrame, by: list[str], value: str, shares: list[float], few: int = 50_000, cells: int = 1024) -> DataFrame:
    """(by, q0, q1, ...): the exact quantiles of a column in each group, interpolated between neighbouring ranks.

    Nulls and NaNs don't count; a group without other values is left out.  Groups are few (samples), and the values finite.  A
    round sorts the rows of each open bracket into cells between its ends, an aggregation with a row a bracket and cell; the cell
    that holds a rank, from its least to its greatest value, is the next bracket.  Both ends of a bracket are values, so each
    round leaves some out; brackets of `few` values at most, or of equal ones, are settled by sorting what they hold.

    The rounds are jobs, so df is kept while they run and the result is a table of a row a group.
    """
    spark = df.sparkSession
    values = df.select(*by, F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x")).persist()
    groups = values.groupBy(*by).agg(F.count("*").alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high")).collect()  # a row a group
    if not by:
        groups = [g for g in groups if g["n"]]
    open_ = []
    for g in groups:
        at = [q * (g["n"] - 1) for q in shares]
        open_.append(Bracket(tuple(g[c] for c in by), g["low"], g["high"], 0, g["n"], {math.floor(a) for a in at} | {math.ceil(a) for a in at}))
    found: dict[tuple, float] = {}
    small: list[Bracket] = []
    while open_:
        wide = []
        for b in open_:
            if b.low == b.high:
                found |= {(b.group, r): b.low for r in b.ranks}
            else:
                (small if b.n <= few else wide).append(b)
        open_ = []
        if not wide:
            break
        # halves, as a difference of large values may be infinite
        place = (F.col("_x") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
        cell = F.least(F.floor(place * cells), F.lit(cells - 1))
        counts = _inside(values, by, wide).groupBy("_b", cell.alias("cell")).agg(
            F.count("*").alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high")
        ).collect()  # brackets x cells
        for i, b in enumerate(wide):
            below = b.below
            for c in sorted((c for c in counts if c["_b"] == i), key=lambda c: c["cell"]):
                if ranks := {r for r in b.ranks if below <= r < below + c["n"]}:
                    open_.append(Bracket(b.group, c["low"], c["high"], below, c["n"], ranks))
                below += c["n"]
    if small:
        ranks = F.create_map(*[F.lit(x) for i, b in enumerate(small) for x in (i, [r - b.below + 1 for r in sorted(b.ranks)])])
        lists = _inside(values, by, small).groupBy("_b").agg(F.sort_array(F.collect_list("_x")).alias("v"))  # `few` values at most
        for r in lists.select("_b", F.transform(ranks[F.col("_b")], lambda i: F.element_at("v", i)).alias("x")).collect():
            b = small[r["_b"]]
            found |= {(b.group, k): x for k, x in zip(sorted(b.ranks), r["x"], strict=True)}
    values.unpersist()
    rows = []
    for g in groups:
        group = tuple(g[c] for c in by)
        out = []
        for q in shares:
            at = q * (g["n"] - 1)
            a, b = found[group, math.floor(at)], found[group, math.ceil(at)]
            out.append(a + (b - a) * (at - math.floor(at)))
        rows.append((*group, *out))
    kinds = [f"`{c}` {t}" for c, t in df.select(*by).dtypes] + [f"q{i} double" for i in range(len(shares))]
    return spark.createDataFrame(rows, ", ".join(kinds))
