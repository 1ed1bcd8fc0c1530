"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

The features of every row are stored once, beside the row. Fitting is one Spark
aggregation over all labelled rows: per class a count, the sums and the cross
products of the features. The driver turns those few hundred
numbers into shrinkage covariances and their Cholesky factors, which are cached
in a model. Scoring is a projection: the two Mahalanobis distances come from
forward substitution with the cached factors, and the score is the logistic of
the log-density difference plus the log prior.

Null text counts as empty; an empty text has defined features and so a score.
Rows without a usable label (null, or neither 0 nor 1) take no part in the fit;
if a class has no row at all, the score is the share of the class that has (0.5
when neither has). Repeated rows count as often as they occur.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from galesol.llm import textstats as S
from galesol.llm.common import prepare, stored

#: Weight of the pooled, and of the spherical part, in each class covariance.
POOLED, SPHERE = 0.10, 0.02
#: Score from which a document is kept.
THRESHOLD = 0.3
#: Largest Mahalanobis step in one feature, so that one odd value can't decide alone.
REACH = 8.0


def features(text: Column) -> Column:
    """Transformed statistics of one text, as array<double>. The logarithms tame heavy tails."""
    text = F.coalesce(text, F.lit(""))
    by_word = S.let(S.words(text), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d"), S.stop_words(w).alias("s"), S.repeats_before(w).alias("r")))

    def build(b: Column, x: Column) -> Column:
        n = b["n"].cast("double") + 20.0  # twenty plain words are added to each text, so that shares of very short ones stay calm
        chars = F.length(text).cast("double") + 100.0
        share = lambda v, of: F.log1p(100.0 * v.cast("double") / of)
        return F.array(
            F.log(F.greatest(b["n"], F.lit(60)).cast("double")),
            F.log((S.word_chars(text) + 110.0) / n),
            share(S.count_of(text, "#*$%&<>"), n),
            share(S.count_of(text, "|"), n),
            share(S.count_of(text, "!"), n),
            share(S.count_of(text, S.UPPER) + 2, chars),
            share(S.count_of(text, S.DIGITS), chars),
            share(S.count_of(text, ".,") + 3, n),
            share(b["s"] + 4, n),
            F.log((20.0 + b["d"]) / n) / F.log(n),
            share(b["r"], n),
            share(x["n_dup_lines"], F.greatest(x["n_lines"], F.lit(1)).cast("double")),
        )

    return S.let(by_word, lambda b: S.let(S.line_counts(text), lambda x: build(b, x)))


N_FEATURES = 12


@dataclass
class Model:
    """Class means, inverse Cholesky factors, log determinants and log priors (class 0, class 1)."""

    means: list[np.ndarray]
    inverse: list[np.ndarray]
    log_det: list[float]
    log_prior: list[float]
    constant: float | None = None
    scale: np.ndarray = field(default_factory=lambda: np.ones(N_FEATURES))

    def score(self, x: Column) -> Column:
        """Probability of label 1 for an array<double> of features."""
        if self.constant is not None:
            return F.lit(self.constant)

        def log_density(c: int) -> Column:
            d = [F.get(x, F.lit(i)) - F.lit(float(self.means[c][i])) for i in range(N_FEATURES)]
            total = F.lit(self.log_prior[c] - 0.5 * self.log_det[c])
            for i in range(N_FEATURES):
                z = sum((d[j] * F.lit(float(self.inverse[c][i, j])) for j in range(i + 1)), F.lit(0.0))
                z = F.greatest(F.lit(-REACH), F.least(F.lit(REACH), z))
                total = total - 0.5 * z * z
            return total

        gap = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), log_density(0) - log_density(1)))
        return 1.0 / (1.0 + F.exp(gap))


def fit(labelled: DataFrame, feature_col: str = "x", label_col: str = "label", pooled: float = POOLED, sphere: float = SPHERE) -> Model:
    """Fit from all labelled rows in one aggregation; only sums reach the driver."""
    k = N_FEATURES
    x = [F.get(F.col(feature_col), F.lit(i)) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(k)] + [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs]
    rows = {r["y"]: r for r in labelled.where(F.col(label_col).isin(0, 1)).groupBy(F.col(label_col).cast("int").alias("y")).agg(F.count("*").alias("n"), *sums).collect()}
    if len(rows) < 2:
        return Model([], [], [], [], constant=float(next(iter(rows))) if rows else 0.5)
    n = [rows[c]["n"] for c in (0, 1)]
    means = [np.array([rows[c][f"s{i}"] for i in range(k)]) / rows[c]["n"] for c in (0, 1)]
    scatter = []
    for c in (0, 1):
        s = np.zeros((k, k))
        for i, j in pairs:
            s[i, j] = s[j, i] = rows[c][f"p{i}_{j}"] / n[c] - means[c][i] * means[c][j]
        scatter.append(s)
    both = (n[0] * scatter[0] + n[1] * scatter[1]) / sum(n)
    inverse, log_det = [], []
    for c in (0, 1):
        cov = (1 - pooled) * scatter[c] + pooled * both
        cov = (1 - sphere) * cov + sphere * max(np.trace(cov) / k, 1e-6) * np.eye(k)
        low = np.linalg.cholesky(cov)
        inverse.append(np.linalg.inv(low))
        log_det.append(float(2 * np.log(np.diag(low)).sum()))
    return Model(means, inverse, log_det, [float(np.log(m / sum(n))) for m in n])


def fold(doc_id: Column) -> Column:
    """The row's fold, 0 to 4, from its id alone; fold 0 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def described(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Stored table (row, x): the input's rows (all or some of their columns) as structs, so that no column name can clash, each with its features.

    Features are computed here once; fit and scores read them."""
    prepare(docs.sparkSession)
    return stored(docs.select(F.struct(*(columns or docs.columns)).alias("row"), features(F.col("text")).alias("x")))


def train(rows: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit on every labelled document of a described() table whose fold is not 0; texts take no part in the join."""
    usable = labels.where((fold(F.col("doc_id")) != 0) & F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("label"))
    return fit(rows.select("row.doc_id", "x").join(usable, "doc_id").select("label", "x"))


def score_documents(rows: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of a described() table. An empty table gives an empty result."""
    scored = rows.select("row.doc_id", (F.coalesce(fold(F.col("row.doc_id")), F.lit(1)) == 0).alias("held_out"), model.score(F.col("x")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(rows: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Those rows behind a described() table whose score reaches the threshold, with their own columns."""
    return rows.where(model.score(F.col("x")) >= threshold).select("row.*")
