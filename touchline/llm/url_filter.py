"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

Native: everything is DataFrame expressions and Spark's own ML transformers; no Python runs on executors.

The labelled table is small: of the distinct URLs (host and path) that a rule decides, at most ``MAX_TRAIN``
of each verdict, those of least hash. Any other table (host, path, verdict) may be given in its place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRAIN = 2_000
FEATURES = 1 << 12
SIZES = (2, 3, 4)
PENALTY = 0.01

# Host and path of a rule, and its verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: str | Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _UPPER.lower())


def path_of(url: str | Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def _by_rules(rules: Sequence[tuple[str, str, str]], value) -> Column:
    """``value`` of the longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for host, path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        own = (F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))
        out = F.when(own & F.startswith(F.col("path"), F.lit(path)), F.lit(value(host, path, verdict))).otherwise(out)
    return out


def grams() -> Column:
    """All character n-grams of host and path, which are marked apart; their ends are marked too."""
    def pieces(name: str, n: int) -> Column:
        text = F.concat(F.lit("^"), F.col(name), F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(f"{name[0]}{n}:"), F.substring(text, i, F.lit(n))))

    return F.concat(*[pieces(name, n) for name in ("host", "path") for n in SIZES])


def _vectors(urls: DataFrame) -> DataFrame:
    hashed = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=FEATURES, binary=True)
    return hashed.transform(urls.withColumn("_grams", grams())).drop("_grams")


def train(labelled: DataFrame, max_train: int = MAX_TRAIN) -> LogisticRegressionModel | None:
    """A model from (host, path, verdict); None without rows."""
    rows = labelled.select("host", "path", (F.col("verdict") == "block").cast("double").alias("label")).distinct()
    order = [F.xxhash64("host", "path"), F.col("host"), F.col("path")]
    chosen = [rows.filter(F.col("label") == v).orderBy(*order).limit(max_train) for v in (0.0, 1.0)]
    # Bounded by 2 * max_train rows; one ordered partition makes the sums the same in every run.
    small = _vectors(chosen[0].union(chosen[1])).coalesce(1)
    if small.isEmpty():
        return None
    return LogisticRegression(
        featuresCol="_features", labelCol="label", regParam=PENALTY, maxIter=50, predictionCol="_block",
        probabilityCol="_p", rawPredictionCol="_raw",
    ).fit(small)


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, labelled: DataFrame | None = None,
                max_train: int = MAX_TRAIN) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url).

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case. Path: from there up to
    ``?``, ``#`` or the end. A null url and one without ``://`` have both empty and are judged by the
    model. Of the rules that fit the longest wins. Every row is kept, repeated ones and null ids too. Without any
    labelled url the model allows; with one verdict alone it gives that one. An empty table gives an empty
    result. Other columns are ignored.
    """
    urls = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    urls = urls.withColumn("rule", _by_rules(rules, lambda h, p, v: h + p))
    urls = urls.withColumn("_verdict", _by_rules(rules, lambda h, p, v: v))
    if labelled is None:
        labelled = urls.filter("rule is not null").withColumn("verdict", F.col("_verdict"))
    model = train(labelled, max_train)
    if model is None:
        judged = urls.withColumn("_block", F.lit(0.0))
    else:
        judged = model.transform(_vectors(urls))
    verdict = F.coalesce("_verdict", F.when(F.col("_block") > 0.5, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
