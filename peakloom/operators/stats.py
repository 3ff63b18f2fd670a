"""Correlations, distances, PCA, multiple testing and the negative-binomial model."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import selection


def sample_pairs(values: DataFrame, row: str = "region_id", value: str = "n", skip_zeros: bool = False) -> DataFrame:
    """For each pair of samples (a < b) the sums over rows that correlations and distances need; rows hold every sample.

    skip_zeros: rows that are zero in all samples don't count."""
    lists = values.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("sample_key", F.col(value).cast("double").alias("x")))).alias("v"))  # a sample each
    if skip_zeros:
        lists = lists.filter(F.exists("v", lambda s: s["x"] != 0))
    a = lists.select(F.posexplode("v").alias("i", "p"), "v").select("p", F.explode(F.slice(F.col("v"), F.col("i") + 2, F.size("v"))).alias("q"))
    x, y = F.col("p.x"), F.col("q.x")
    return a.groupBy(F.col("p.sample_key").alias("a"), F.col("q.sample_key").alias("b")).agg(
        F.count("*").alias("m"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * y).alias("sxy"), F.sum(x * x).alias("sxx"),
        F.sum(y * y).alias("syy"), F.sum((x - y) * (x - y)).alias("sd")
    )


def pearson(values: DataFrame, row: str = "region_id", value: str = "n", skip_zeros: bool = False) -> DataFrame:
    p = sample_pairs(values, row, value, skip_zeros)
    m = F.col("m")
    den = F.sqrt((m * F.col("sxx") - F.col("sx") ** 2) * (m * F.col("syy") - F.col("sy") ** 2))
    return p.select("a", "b", F.when(den > 0, (m * F.col("sxy") - F.col("sx") * F.col("sy")) / den).alias("r"))


def euclidean(values: DataFrame, row: str = "region_id", value: str = "n") -> DataFrame:
    return sample_pairs(values, row, value).select("a", "b", F.sqrt("sd").alias("distance"))


def average_ranks(values: DataFrame, value: str = "n", by: str = "sample_key") -> DataFrame:
    """Ranks with average ties, from a histogram of values: only distinct values are sorted."""
    hist = values.groupBy(by, value).agg(F.count("*").alias("_k"))
    below = F.sum("_k").over(Window.partitionBy(by).orderBy(value)) - F.col("_k")
    ranks = hist.withColumn("rank", below + (F.col("_k") + 1) / 2).drop("_k")
    return values.join(ranks, [by, value])


def spearman(values: DataFrame, row: str = "region_id", value: str = "n", skip_zeros: bool = False) -> DataFrame:
    if skip_zeros:
        some = values.groupBy(row).agg(F.max(F.col(value) != 0).alias("_some")).filter("_some").select(row)
        values = values.join(some, row, "left_semi")
    return pearson(average_ranks(values, value), row, "rank")


def pca(values: DataFrame, row: str = "region_id", value: str = "value", top: int = 500) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(samples, coordinates, percent of variance) from the rows of most variance.  Spark makes the sample x sample Gram matrix."""
    most = values.groupBy(row).agg(F.var_samp(value).alias("_v"), F.avg(value).alias("_m")).orderBy(F.col("_v").desc(), row).limit(top)
    centred = values.join(F.broadcast(most), row).withColumn("_c", F.col(value) - F.col("_m"))  # at most `top` rows
    gram = sample_pairs(centred, row, "_c").select("a", "b", "sxy").collect()  # samples squared
    own = centred.groupBy(F.col("sample_key").alias("a")).agg(F.sum(F.col("_c") * F.col("_c")).alias("sxy")).select("a", F.col("a").alias("b"), "sxy").collect()  # a row a sample
    gram += own
    names = sorted({r.a for r in own})
    at = {k: i for i, k in enumerate(names)}
    g = np.zeros((len(names), len(names)))
    for r in gram:
        g[at[r.a], at[r.b]] = g[at[r.b], at[r.a]] = r.sxy
    w, v = np.linalg.eigh(g)
    order = np.argsort(-w)
    w, v = np.maximum(w[order], 0), v[:, order]
    v *= np.where(v[np.abs(v).argmax(0), np.arange(v.shape[1])] < 0, -1, 1)
    return names, v * np.sqrt(w), 100 * w / max(w.sum(), 1e-300)


def bh(df: DataFrame, p: str = "pvalue", keep: Column | None = None, buckets: int = 64) -> DataFrame:
    """padj by Benjamini-Hochberg; null where p is null or keep is false.

    Distinct p-values are counted first; ranges of p then get their counts and minima from ranges above by a small table, so no
    task sorts all rows.
    """
    use = F.col(p).isNotNull() if keep is None else F.col(p).isNotNull() & keep
    hist = df.filter(use).groupBy(F.col(p).alias("_p")).agg(F.count("*").alias("_k"))
    hist = hist.withColumn(
        "_b", F.least(F.lit(buckets - 1), F.greatest(F.lit(0), F.floor(-F.log2(F.greatest("_p", F.lit(1e-300))) * 2)))
    )  # larger bucket, smaller p
    sums = hist.groupBy("_b").agg(F.sum("_k").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(F.lit(1)))  # a row a bucket
    before = sums.select("_b", (F.sum("_n").over(Window.orderBy(F.col("_b").desc())) - F.col("_n")).alias("_below"), total.alias("_m"))
    inside = Window.partitionBy("_b").orderBy("_p")
    q = hist.join(F.broadcast(before), "_b").withColumn("_q", F.col("_p") * F.col("_m") / (F.col("_below") + F.sum("_k").over(inside)))
    q = q.withColumn("_in", F.min("_q").over(Window.partitionBy("_b").orderBy(F.col("_p").desc())))
    mins = q.groupBy("_b").agg(F.min("_q").alias("_min"))
    above = mins.select("_b", F.min("_min").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_above"))
    adj = q.join(F.broadcast(above), "_b").select("_p", F.least(F.lit(1.0), "_in", F.coalesce("_above", F.lit(1.0))).alias("_adj"))
    out = df.join(adj, F.col(p) == F.col("_p"), "left")
    return out.withColumn("padj", F.when(use, F.col("_adj"))).drop("_p", "_adj")


def significant(alpha: float, min_lfc: float = 0.0, padj: str = "padj", lfc: str = "log2_fc") -> Column:
    return F.coalesce((F.col(padj) <= alpha) & (F.abs(lfc) >= min_lfc), F.lit(False))


def direction(numerator: str, reference: str, lfc: str = "log2_fc") -> Column:
    return F.when(F.col(lfc) > 0, F.lit(f"higher_in_{numerator}")).when(F.col(lfc) < 0, F.lit(f"higher_in_{reference}")).when(F.col(lfc) == 0, "unchanged")


def _erfc(x: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.erfc, x.ravel()), float, x.size).reshape(x.shape)


@dataclass(frozen=True)
class Design:
    """A model matrix: a row a sample, columns named `(intercept)` and `term:level`; the first level of a term is its baseline."""

    samples: list[str]
    columns: list[str]
    x: np.ndarray
    levels: dict[str, list[str]]

    def contrast(self, term: str, numerator: str, reference: str) -> np.ndarray:
        """The vector of coefficients whose sum is the log ratio of two levels of a term."""
        out = np.zeros(len(self.columns))
        for level, sign in ((numerator, 1), (reference, -1)):
            if level not in self.levels[term]:
                raise ValueError(f"{term} {level} is not in the model")
            if level != self.levels[term][0]:
                out[self.columns.index(f"{term}:{level}")] += sign
        return out

    def aliased(self) -> list[str]:
        """Columns that are combinations of columns before them."""
        out, kept = [], []
        for i, name in enumerate(self.columns):
            if np.linalg.matrix_rank(self.x[:, [*kept, i]]) <= len(kept):
                out.append(name)
            else:
                kept.append(i)
        return out


def design(samples: list[str], terms: dict[str, dict[str, str]], orders: dict[str, list[str]] | None = None) -> Design:
    """The matrix `~ term + term`, treatment coded.  terms: for each factor, blocks first, its level for every sample; a factor's
    levels are those of the samples, in the given order or sorted.  Terms that earlier ones determine are an error that names them.
    """
    columns, parts, levels = ["(intercept)"], [np.ones(len(samples))], {}
    for term, of in terms.items():
        if missing := [s for s in samples if of.get(s) is None]:
            raise ValueError(f"no {term} for {missing}")
        seen = {of[s] for s in samples}
        levels[term] = [v for v in (orders or {}).get(term, sorted(seen)) if v in seen]
        if lost := seen - set(levels[term]):
            raise ValueError(f"the order of {term} lacks {sorted(lost)}")
        for level in levels[term][1:]:
            columns.append(f"{term}:{level}")
            parts.append(np.array([of[s] == level for s in samples], float))
    out = Design(samples, columns, np.stack(parts, 1), levels)
    if names := out.aliased():
        raise ValueError(f"the design is not of full rank: {', '.join(names)} follow from the terms before")
    return out


def full_rank(x: np.ndarray) -> bool:
    return np.linalg.matrix_rank(x) == x.shape[1]


def _irls(k: np.ndarray, x: np.ndarray, offset: np.ndarray, alpha: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Negative-binomial fits of all rows at once: (beta, covariance, mu).  A small ridge keeps all-zero groups finite."""
    mu = np.maximum(k, 0.5)
    beta = np.zeros((len(k), x.shape[1]))
    ridge = 1e-6 * np.eye(x.shape[1])
    for _ in range(rounds):
        w = mu / (1 + alpha[:, None] * mu)
        z = np.log(mu) - offset + (k - mu) / mu
        xtwx = np.einsum("ni,rn,nj->rij", x, w, x) + ridge
        new = np.linalg.solve(xtwx, np.einsum("ni,rn->ri", x, w * z)[:, :, None])[:, :, 0]
        new = np.clip(new, -30, 30)
        done = np.abs(new - beta).max() < 1e-8
        beta = new
        mu = np.maximum(np.exp(np.clip(beta @ x.T + offset, -30, 30)), 1e-6)
        if done:
            break
    w = mu / (1 + alpha[:, None] * mu)
    return beta, np.linalg.inv(np.einsum("ni,rn,nj->rij", x, w, x) + ridge), mu


def _likelihood(k: np.ndarray, mu: np.ndarray, alpha: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cox-Reid adjusted profile log-likelihood for each row and dispersion of a grid (rows x grid)."""
    r = 1 / alpha
    # log-gamma of k + r minus log-gamma of r as a sum over the count, by Stirling for large arguments
    lg = lambda v: (v - 0.5) * np.log(v) - v + 1 / (12 * v) - 1 / (360 * v**3)
    ratio = lambda kk, rr: lg(kk + rr + 8) - lg(rr + 8) - sum(np.log((kk + rr + i) / (rr + i)) for i in range(8))
    kk, m = k[:, None, :], mu[:, None, :]
    rr = r[None, :, None]
    ll = (ratio(kk, rr) - (kk + rr) * np.log1p(m / rr) + kk * np.log(m / rr)).sum(2)
    w = m / (1 + m / rr)
    info = np.einsum("ni,rgn,nj->rgij", x, w, x)
    return ll - 0.5 * np.linalg.slogdet(info + 1e-9 * np.eye(x.shape[1]))[1]


GRID = np.exp(np.linspace(math.log(1e-6), math.log(20.0), 60))


def _rows(b, names: list[str]) -> np.ndarray:
    return b.column("k").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(names))


def model(conditions: dict[str, str], order: list[str], blocks: dict[str, dict[str, str]] | None = None) -> Design:
    """`~ [block +] condition` over the samples of `conditions`, ordered by condition and name."""
    samples = sorted(conditions, key=lambda s: (order.index(conditions[s]), s))
    return design(samples, {**(blocks or {}), "condition": conditions}, {"condition": order})


def _gene_dispersions(counts: DataFrame, factors: dict[str, float], of: Design) -> tuple[DataFrame, np.ndarray]:
    """(region_id, k, base_mean, disp), kept, with the offsets that were used."""
    names, x = of.samples, of.x
    offset = np.log(np.array([factors[s] for s in names]))
    wide = counts.filter(F.col("sample_key").isin(names)).groupBy("region_id").agg(F.map_from_entries(F.collect_list(F.struct("sample_key", "n"))).alias("m"))
    wide = wide.select(
        "region_id", F.array(*[F.coalesce(F.col("m")[s], F.lit(0)).cast("double") for s in names]).alias("k")
    ).filter(F.exists("k", lambda v: v > 0))

    def genewise(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                k = _rows(b, names)
                base = (k / np.exp(offset)).mean(1)
                _, _, mu = _irls(k, x, offset, np.full(len(k), 0.1))
                best = GRID[_likelihood(k, mu, GRID, x).argmax(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(base), pa.array(best)], ["region_id", "k", "base_mean", "disp"])

    gene = wide.mapInArrow(
        genewise, f"region_id {counts.schema['region_id'].dataType.simpleString()}, k array<double>, base_mean double, disp double"
    ).persist()
    return gene, offset


def _trend(gene: DataFrame) -> tuple[float, float, DataFrame]:
    """(a0, a1) of the dispersion a1 / mean + a0 and the regions it comes from.

    Least squares of dispersion on 1 / mean over regions whose estimate left the grid's floor.
    """
    t = gene.filter(F.col("disp") > 1e-5).withColumn("u", 1 / F.col("base_mean")).filter("base_mean > 0")
    r = t.agg(F.count("*").alias("n"), F.avg("u").alias("u"), F.avg("disp").alias("d"), F.covar_pop("u", "disp").alias("c"), F.var_pop("u").alias("v")).first()
    slope = max(0.0, r.c / r.v) if r.n and r.v else 0.0
    a0 = max(1e-4, (r.d - slope * r.u) if r.n else 0.05)
    return a0, slope, t


def dispersion_trend(
    counts: DataFrame, factors: dict[str, float], conditions: dict[str, str], order: list[str], blocks: dict[str, dict[str, str]] | None = None
) -> tuple[float, float]:
    """(a0, a1) of the dispersion trend a1 / mean + a0 that nb_fit() takes for the same arguments."""
    gene, _ = _gene_dispersions(counts, factors, model(conditions, order, blocks))
    a0, slope, _ = _trend(gene)
    gene.unpersist()
    return a0, slope


#: What a tested region has besides its id and contrast.
TESTED = "base_mean double, log2_fc double, lfc_se double, stat double, pvalue double"


def nb_comparisons(counts: DataFrame, factors: dict[str, float], of: Design, comparisons: dict[str, tuple[str, str]], term: str = "condition") -> DataFrame:
    """One model over the samples of a design; a row a region and comparison, or a row with only `error` where one failed.

    comparisons: id to (numerator, reference) levels of the term.  Counts (region_id, sample_key, n) become one array a region
    (samples are few), regions are fitted in Arrow batches.  Gene-wise dispersions maximise the Cox-Reid likelihood on a grid;
    their trend a1 / mean + a0 comes from two Spark aggregates; the final dispersion shrinks to the trend by a log-normal prior.
    Wald tests follow for every comparison.

    Comparisons are isolated: one that names a level without samples, or whose test of a batch raises or has no finite standard
    error, gives rows of its own with region_id null and the message in `error`, and the others go on.
    """
    spark, names, x = counts.sparkSession, of.samples, of.x
    vectors, broken = {}, []
    for key, (numerator, reference) in comparisons.items():
        try:
            vectors[key] = of.contrast(term, numerator, reference)
        except ValueError as e:
            broken.append((key, str(e)))
    gene, offset = _gene_dispersions(counts, factors, of)
    a0, slope, t = _trend(gene)
    away = t.select(F.abs(F.ln("disp") - F.ln(F.lit(a0) + F.lit(slope) * F.col("u"))).alias("d"))
    spread = next((r["q0"] for r in selection.quantiles(away, [], "d", [0.5]).collect()), None)
    prior = max(0.25, (1.4826 * (spread or 1.0)) ** 2 - 2.0 / max(1, len(names) - x.shape[1]))
    ids = counts.schema["region_id"].dataType

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        columns = ["region_id", "contrast", "base_mean", "log2_fc", "lfc_se", "stat", "pvalue", "error"]
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                k, base = _rows(b, names), b.column("base_mean").to_numpy()
                trend = a0 + slope / np.maximum(base, 1e-8)
                _, _, mu = _irls(k, x, offset, trend)
                post = _likelihood(k, mu, GRID, x) - (np.log(GRID)[None, :] - np.log(trend)[:, None]) ** 2 / (2 * prior)
                alpha = GRID[post.argmax(1)]
                beta, cov, _ = _irls(k, x, offset, alpha)
                for key, c in vectors.items():
                    try:
                        made = [pa.array(v) for v in wald(beta, cov, c)]
                        first, error, n = b.column(0), pa.nulls(len(k), pa.string()), len(k)
                        made.insert(0, pa.array(base))
                    except (ValueError, np.linalg.LinAlgError) as e:
                        first, error, n = pa.nulls(1, b.column(0).type), pa.array([str(e)]), 1
                        made = [pa.nulls(1, pa.float64())] * 5
                    yield pa.RecordBatch.from_arrays([first, pa.array([key] * n, pa.string()), *made, error], columns)

    out = gene.mapInArrow(run, f"region_id {ids.simpleString()}, contrast string, {TESTED}, error string")
    if not broken:
        return out
    lost = spark.createDataFrame(broken, "contrast string, error string")  # a row a comparison at most
    return out.unionByName(lost.select(*[F.col(f.name) if f.name in lost.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in out.schema]))


def wald(beta: np.ndarray, cov: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    """log2 fold change, its standard error, the statistic and the two-sided p-value of a contrast for all rows."""
    lfc, var = beta @ c, np.einsum("i,rij,j->r", c, cov, c)
    if not np.isfinite(var).all() or (var <= 0).any():
        raise ValueError("a standard error is not finite and above 0")
    se = np.sqrt(var)
    z = lfc / se
    return [lfc / math.log(2), se / math.log(2), z, _erfc(np.abs(z) / math.sqrt(2))]


def completed(tested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results, failures) of nb_comparisons(): the rows of comparisons of which no batch failed, and (contrast, message)."""
    failures = tested.filter(F.col("error").isNotNull()).groupBy("contrast").agg(F.min("error").alias("message"))
    good = tested.filter(F.col("error").isNull()).join(F.broadcast(failures.select("contrast")), "contrast", "left_anti")  # a row a comparison
    return good.drop("error"), failures


def nb_fit(counts: DataFrame, factors: dict[str, float], conditions: dict[str, str], order: list[str], blocks: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """nb_comparisons() of `~ [block +] condition` for every pair of conditions (later over earlier); contrast is `later|earlier`.

    A pair that fails fails the job, as nothing here tells who reads the result; see completed() for the other way."""
    of = model(conditions, order, blocks)
    if lost := [c for c in order if c not in of.levels["condition"]]:
        raise ValueError(f"conditions without samples: {lost}")
    pairs = {f"{b}|{a}": (b, a) for i, a in enumerate(order) for b in order[i + 1 :]}
    out = nb_comparisons(counts, factors, of, pairs)
    stop = F.raise_error(F.concat_ws(": ", "contrast", "error")).cast("string")
    return out.withColumn("contrast", F.when(F.col("error").isNotNull(), stop).otherwise(F.col("contrast"))).drop("error")


def independent_filter(df: DataFrame, alpha: float, steps: int = 50) -> tuple[DataFrame, float]:
    """padj after the mean threshold that gives most rejections (the first within one residual SD of the most)."""
    grid = [i / steps * 0.95 for i in range(steps)]
    cuts = next((list(r) for r in selection.quantiles(df, [], "base_mean", grid).collect()), [0.0])
    found = []
    sub = df.select("pvalue", "base_mean").filter("pvalue is not null")
    # rejections at every threshold in one pass: BH per threshold over a histogram of -log10 p
    hist = sub.select(
        F.floor(-F.log10(F.greatest("pvalue", F.lit(1e-300))) * 20).alias("h"),
        F.explode(F.filter(
            F.array(*[F.lit(i) for i in range(len(cuts))]),
            lambda i: F.col("base_mean") >= F.element_at(F.array(*[F.lit(float(c)) for c in cuts]), i + 1)
        )).alias("t")
    ).groupBy("t", "h").agg(F.count("*").alias("n")).collect()  # thresholds x 6000 bins at most
    for t in range(len(cuts)):
        bins = sorted(((r.h, r.n) for r in hist if r.t == t), reverse=True)
        m, seen, best = sum(n for _, n in bins), 0, 0
        for h, n in bins:
            seen += n
            if 10 ** (-h / 20) * m / seen <= alpha:
                best = seen
        found.append(best)
    y = np.array(found, float)
    smooth = np.convolve(np.pad(y, 2, mode="edge"), np.ones(5) / 5, "valid")
    limit = smooth.max() - np.sqrt(np.mean((y - smooth) ** 2))
    at = int(np.argmax(y >= limit)) if (y >= limit).any() else int(y.argmax())
    return bh(df, keep=F.col("base_mean") >= float(cuts[at])), float(cuts[at])


def vst(n: Column, a0: float, a1: float) -> Column:
    """Variance-stabilising transform for dispersion a1 / mean + a0, in log2 units."""
    return F.log2((1 + a1 + 2 * a0 * n + 2 * F.sqrt(a0 * n * (1 + a1 + a0 * n))) / (4 * a0))


def report(results: DataFrame, alpha: float = 0.05, min_lfc: float = 0.0, by: str = "contrast") -> DataFrame:
    """The results that a report shows: padj (Benjamini-Hochberg inside each contrast) at most alpha and |log2 fold change| at
    least min_lfc, with direction."""
    names = [r[0] for r in results.select(by).distinct().collect()]  # a row a contrast
    out = results.limit(0).withColumn("padj", F.lit(None).cast("double"))
    for name in sorted(names):
        out = out.unionByName(bh(results.filter(F.col(by) == name)))
    numerator, reference = F.split(by, r"\|")[0], F.split(by, r"\|")[1]
    higher = F.when(F.col("log2_fc") > 0, F.concat(F.lit("higher_in_"), numerator)).when(F.col("log2_fc") < 0, F.concat(F.lit("higher_in_"), reference)).otherwise("unchanged")
    return out.filter(significant(alpha, min_lfc)).withColumn("direction", higher)


def ma_table(results: DataFrame, alpha: float = 0.05, limit: float = 5.0) -> DataFrame:
    """Rows of an MA plot: mean of normalised counts, log2 fold change cut to the plot's limits (beyond tells which were), and
    whether padj is at most alpha.  Regions with mean 0 or without fold change have no point."""
    lfc = F.col("log2_fc")
    points = results.filter((F.col("base_mean") > 0) & lfc.isNotNull())
    return points.withColumns({
        "log10_mean": F.log10("base_mean"), "shown_lfc": F.greatest(F.least(lfc, F.lit(limit)), F.lit(-limit)),
        "beyond": F.when(lfc > limit, "above").when(lfc < -limit, "below"), "significant": F.coalesce(F.col("padj") <= alpha, F.lit(False))
    })


def volcano(df: DataFrame) -> DataFrame:
    return df.withColumn("neg_log10_p", -F.log10(F.greatest("pvalue", F.lit(2.2250738585072014e-308))))
