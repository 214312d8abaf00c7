"""URL filtering: listed rules first, boosted trees on lexical features for the rest.

A rule names a host (with all its subdomains) and a path prefix; the longest one that fits decides. Urls
that rules decide are the labelled ones: gradient-boosted trees learn from a bounded sample of them how
blocked urls look (length, depth, digits, entropy, parameters, host shape, statistics of the host's
last label) and judge the urls that no rule fits. All of it is built-in functions and ``pyspark.ml``.

Defined cases: a null url, or one without ``://``, has empty host and path and is judged by the trees on
what text it has; without rules that fit both ways there is one class, which every other url gets
(``allow`` if nothing is labelled); rows with a null id and repeated rows are judged like any other; an
empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.llm.common import written

ALLOW, BLOCK = "allow", "block"
#: Buckets that last host labels are hashed into for their statistics.
SUFFIX_BUCKETS = 4096
#: Parts of the labelled urls; a url learns the share of blocked ones at its suffix from the other parts.
FOLDS = 5
MAX_RULES = 1000
FEATURES = (
    "length", "host_length", "labels", "depth", "digit_ratio", "entropy", "parameters", "query_length",
    "hyphens", "has_fragment", "secure", "suffix_share", "suffix_blocked",
)


def with_parts(pages: DataFrame, url: Column) -> DataFrame:
    """``pages`` with ``__url`` (null: empty), ``__host`` and ``__path``."""
    text = F.coalesce(url, F.lit(""))
    rest = F.when(text.contains("://"), F.expr("substring(__url, locate('://', __url) + 3)")).otherwise("")
    host = F.regexp_extract(F.col("__rest"), r"^[^/?#]*", 0)
    return (
        pages.withColumn("__url", text)
        .withColumn("__rest", rest)
        .withColumn("__host", F.translate(host, string.ascii_uppercase, string.ascii_lowercase))
        .withColumn("__path", F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1))
        .drop("__rest")
    )


def _fits(rule: str) -> Column:
    host, _, path = rule.partition("/")
    on_host = (F.col("__host") == host) | F.col("__host").endswith("." + host)
    return on_host & F.col("__path").startswith("/" + path)


def with_rule(parts: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``__rule`` (null if none fits) and ``__ruled``, its verdict, from (verdict, rule) pairs."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    longest = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    hits = [(F.when(_fits(rule), F.lit(rule)), F.when(_fits(rule), F.lit(verdict))) for verdict, rule in longest]
    none = F.lit(None).cast("string")
    return parts.withColumns(
        {"__rule": F.coalesce(*(h for h, _ in hits), none), "__ruled": F.coalesce(*(v for _, v in hits), none)}
    )


def _count(text: str, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _entropy(text: str) -> Column:
    """Bits per character of the characters of ``text``."""
    n = F.length(text)
    c = lambda x: (F.length(text) - F.length(F.replace(F.col(text), x, F.lit("")))) / F.length(x)
    part = lambda x: F.when(F.length(x) > 0, c(x) * F.log2(c(x))).otherwise(0.0)
    parts = F.transform(F.array_distinct(F.split(text, "")), part)
    return F.when(n > 0, F.log2(n) - F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / n).otherwise(0.0)


def with_features(ruled: DataFrame) -> DataFrame:
    """Lexical features of ``__url``, and the bucket of the host's last label."""
    query = F.regexp_extract("__url", r"\?([^#]*)", 1)
    n = F.length("__url").cast("double")
    return (
        ruled.withColumn("__query", query)
        .withColumns(
            {
                "length": n,
                "host_length": F.length("__host").cast("double"),
                "labels": _count("__host", r"\."),
                "depth": _count("__path", "/"),
                "digit_ratio": F.when(n > 0, _count("__url", "[0-9]") / n).otherwise(0.0),
                "entropy": _entropy("__url"),
                "parameters": _count("__query", "="),
                "query_length": F.length("__query").cast("double"),
                "hyphens": _count("__host", "-"),
                "has_fragment": F.col("__url").contains("#").cast("double"),
                "secure": F.col("__url").startswith("https:").cast("double"),
                "__bucket": F.pmod(F.xxhash64(F.substring_index("__host", ".", -1)), F.lit(SUFFIX_BUCKETS)).cast("int"),
            }
        )
        .drop("__query")
    )


def _fold() -> Column:
    return F.pmod(F.xxhash64("__url", F.lit("fold")), F.lit(FOLDS)).cast("int")


def _suffix_counts(ruled: DataFrame) -> list:
    """Urls, labelled and blocked ones per bucket and fold: ``SUFFIX_BUCKETS * FOLDS`` rows at most."""
    blocked = F.sum((F.col("__ruled") == BLOCK).cast("bigint"))
    counts = (F.count("*").alias("n"), F.count("__ruled").alias("labelled"), F.coalesce(blocked, F.lit(0)).alias("blocked"))
    return ruled.groupBy("__bucket", _fold().alias("__fold")).agg(*counts).collect()


def _suffix_tables(counts: list, without: int | None = None) -> tuple[dict[int, float], dict[int, float], int, int]:
    """Per bucket the share of all urls and the (smoothed) share of blocked among labelled ones.

    ``without`` leaves the labels of one fold out.
    """
    total, labelled, bad = sum(r["n"] for r in counts), 0, 0
    n: dict[int, int] = {}
    told: dict[int, list[int]] = {}
    for r in counts:
        n[r["__bucket"]] = n.get(r["__bucket"], 0) + r["n"]
        own = told.setdefault(r["__bucket"], [0, 0])
        if r["__fold"] != without:
            own[0] += r["labelled"]
            own[1] += r["blocked"]
            labelled += r["labelled"]
            bad += r["blocked"]
    prior = bad / labelled if labelled else 0.0
    share = {b: k / total for b, k in n.items()}
    rate = {b: (blocked + 5 * prior) / (known + 5) for b, (known, blocked) in told.items()}
    return share, rate, labelled, bad


def _looked_up(table: dict[int, float]) -> Column:
    values = [table.get(i, 0.0) for i in range(SUFFIX_BUCKETS)]
    return F.element_at(F.lit(values), F.col("__bucket") + 1)


def _learning_rows(ruled: DataFrame, counts: list, share: dict[int, float], rows: int, seed: int, spared: int | None) -> DataFrame:
    """About ``rows`` labelled urls with their features and ``label``; the suffix statistics come from other folds.

    Urls of the fold ``spared`` do not enter, neither as rows nor in statistics.
    """
    known = sum(r["labelled"] for r in counts if r["__fold"] != spared)
    left = [r for r in counts if r["__fold"] != spared]
    rates = [(fold, b, v) for fold in range(FOLDS) for b, v in _suffix_tables(left, fold)[1].items()]
    table = F.broadcast(ruled.sparkSession.createDataFrame(rates, "__fold int, __bucket int, suffix_blocked double"))
    hashed = F.pmod(F.xxhash64("__url", F.lit(seed)), F.lit(1 << 30))
    drawn = ruled.withColumn("__fold", _fold()).where(
        F.col("__ruled").isNotNull() & (hashed < int(min(1.0, rows / max(known, 1)) * (1 << 30)))
    )
    if spared is not None:
        drawn = drawn.where(F.col("__fold") != spared)
    return written(
        drawn.withColumn("suffix_share", _looked_up(share)).join(table, ["__fold", "__bucket"])
        .select(*FEATURES, (F.col("__ruled") == BLOCK).cast("double").alias("label")).limit(2 * rows),
        "url-sample",
    )


def _model(sample: DataFrame, trees: int, depth: int, seed: int) -> tuple[VectorAssembler, object]:
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="__features")
    booster = GBTClassifier(
        featuresCol="__features", labelCol="label", predictionCol="__prediction",
        maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed,
    )
    booster.setProbabilityCol("__probability").setRawPredictionCol("__raw")
    return assembler, booster.fit(assembler.transform(sample))


def held_out_accuracy(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    url_col: str = "url",
    sample_rows: int = 20_000,
    trees: int = 20,
    depth: int = 4,
    seed: int = 5,
) -> DataFrame:
    """(n, blocked, accuracy, base): how often trees that never saw a fifth of the labelled urls judge these as the rules do.

    ``base`` is the share of the commoner verdict among them. Without labelled urls of both kinds there is no row.
    """
    slim = pages.select(F.col(url_col).cast("string").alias("__given"))
    ruled = with_features(with_rule(with_parts(slim, F.col("__given")), rules))
    counts = _suffix_counts(ruled)
    share, rate, labelled, bad = _suffix_tables(counts, 0)
    none = ruled.sparkSession.createDataFrame([], "n bigint, blocked bigint, accuracy double, base double")
    if not 0 < bad < labelled:
        return none
    assembler, model = _model(_learning_rows(ruled, counts, share, sample_rows, seed, 0), trees, depth, seed)
    asked = ruled.where(F.col("__ruled").isNotNull() & (_fold() == 0)).withColumns(
        {"suffix_share": _looked_up(share), "suffix_blocked": _looked_up(rate)}
    )
    truth = (F.col("__ruled") == BLOCK).cast("double")
    judged = model.transform(assembler.transform(asked)).agg(
        F.count("*").alias("n"), F.sum(truth).cast("bigint").alias("blocked"), F.avg((F.col("__prediction") == truth).cast("double")).alias("accuracy"),
    )
    part = F.col("blocked") / F.col("n")
    return judged.where("n > 0").withColumn("base", F.greatest(part, 1 - part))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    sample_rows: int = 20_000,
    trees: int = 20,
    depth: int = 4,
    seed: int = 5,
) -> DataFrame:
    """Per row: id, ``host``, ``path``, ``rule``, ``verdict`` and ``block_score`` (null where a rule decides).

    The trees learn from about ``sample_rows`` labelled rows, picked by a hash of the url; suffix
    statistics cover all rows; a labelled row learns the share of blocked urls at its suffix from other rows. Only
    the statistics' rows, ``SUFFIX_BUCKETS * FOLDS`` at most, reach the driver.
    """
    slim = pages.select(F.col(id_col).alias("__id"), F.col(url_col).cast("string").alias("__given"))
    ruled = with_features(with_rule(with_parts(slim, F.col("__given")), rules))
    counts = _suffix_counts(ruled)
    share, rate, labelled, bad = _suffix_tables(counts)
    facts = ruled.withColumns({"suffix_share": _looked_up(share), "suffix_blocked": _looked_up(rate)})
    if 0 < bad < labelled:
        sample = _learning_rows(ruled, counts, share, sample_rows, seed, None)
        assembler, model = _model(sample, trees, depth, seed)
        scored = model.transform(assembler.transform(facts)).withColumn("__score", vector_to_array("__probability")[1])
    else:
        scored = facts.withColumn("__score", F.lit(float(bad > 0)))
    learned = F.when(F.col("__score") > 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select(
        F.col("__id").alias(id_col),
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__rule").alias("rule"),
        F.coalesce("__ruled", learned).alias("verdict"),
        F.when(F.col("__ruled").isNull(), F.col("__score")).alias("block_score"),
    )
