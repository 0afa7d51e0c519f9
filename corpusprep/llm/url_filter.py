"""URL verdicts: host rules first, then boosted trees over lexical features.

Everything is a column expression. Labels for the trees are the verdicts of the rules
on the URLs they cover; the model is fitted on a bounded sample of those.

Cases: a NULL URL or one without ``://`` has an empty host and path and is judged by
the model like any other; repeated rows give repeated results; with labels of one kind
only (or none) the verdict is that label (or ``allow``); other columns are dropped; an empty
table gives an empty result; a URL may have any length; of URLs with equal hashes those that
come first in order are learned from.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import ascii_lower
from corpusprep.session import materialise

TRAIN_ROWS = 20_000
ROUNDS = 10
DEPTH = 4


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and a path prefix, such as ``example.org/en/``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``, without query and fragment; empty if there is none."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(
        F.expr("substring(url, instr(url, '://') + 3)"), "#", 1)).otherwise(F.lit(""))
    return F.coalesce(F.substring_index(rest, "?", 1), F.lit(""))


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` (A-Z in lower case) and ``path`` to a table with ``url``."""
    return (
        pages.withColumn("__rest", after_scheme(F.col("url")))
        .withColumn("host", ascii_lower(F.substring_index("__rest", "/", 1)))
        .withColumn("path", F.expr("substring(__rest, length(substring_index(__rest, '/', 1)) + 1)"))
        .drop("__rest")
    )


def matched_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; NULL where none fits."""
    rule = verdict = None
    for r in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, r.text) if rule is None else rule.when(fits, r.text)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def entropy(text: Column) -> Column:
    """Bits per character of the letter, digit and sign distribution of a short string."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.translate(text, c, ""))) / F.greatest(n, F.lit(1))
    terms = [F.when(share(c) > 0, -share(c) * F.log2(share(c))).otherwise(0.0)
             for c in "abcdefghijklmnopqrstuvwxyz0123456789-._/%"]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


FEATURES = (
    "n_url", "n_host", "n_path", "depth", "labels", "digits", "signs", "host_entropy",
    "params", "has_query", "fragment", "secure", "dotted_end", "suffix_block", "suffix_share",
)


def lexical(parts: DataFrame) -> DataFrame:
    """Adds the lexical features and the host's ``suffix`` (its last label)."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.length(url)
    without = lambda c: n - F.length(F.translate(url, c, ""))
    path = F.col("path")
    host = F.col("host")
    query = F.when(F.instr(url, "?") > 0, F.substring_index(url, "?", -1)).otherwise("")
    return parts.withColumns({
        "suffix": F.substring_index(host, ".", -1),
        "n_url": n.cast("double"), "n_host": F.length(host).cast("double"),
        "n_path": F.length(path).cast("double"),
        "depth": (F.length(path) - F.length(F.translate(path, "/", ""))).cast("double"),
        "labels": (F.length(host) - F.length(F.translate(host, ".", ""))).cast("double"),
        "digits": without("0123456789") / F.greatest(n, F.lit(1)),
        "signs": without("-_%&=~+") / F.greatest(n, F.lit(1)),
        "host_entropy": entropy(host),
        "params": F.when(query == "", 0.0).otherwise(
            (F.length(query) - F.length(F.translate(query, "&", "")) + 1).cast("double")),
        "has_query": (F.instr(url, "?") > 0).cast("double"),
        "fragment": (F.instr(url, "#") > 0).cast("double"),
        "secure": ascii_lower(url).startswith("https").cast("double"),
        "dotted_end": F.substring_index(path, "/", -1).contains(".").cast("double"),
    })


def with_suffix_statistics(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    joined = rows.join(statistics, "suffix", "left")
    return joined.fillna({"suffix_block": 0.5, "suffix_share": 0.0})


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url",
    train_rows: int = TRAIN_ROWS, rounds: int = ROUNDS, depth: int = DEPTH,
) -> DataFrame:
    """``(key, host, path, rule, verdict, block_score)`` of every row.

    ``train_rows`` bounds the labelled URLs the trees are fitted on; which ones is
    decided by a hash of the URL. Suffix statistics count all labelled URLs.
    """
    parts = with_parts(pages.select(F.col(key).alias("__key"), F.col(url).alias("url")))
    rule, verdict = matched_rule(rules, F.col("host"), F.col("path"))
    rows = lexical(parts).withColumns({"rule": rule, "__label": verdict})

    labelled = rows.filter(F.col("__label").isNotNull())
    block = (F.col("__label") == "block").cast("double")
    per_suffix = labelled.groupBy("suffix").agg(F.sum(block).alias("b"), F.count("*").alias("n"))
    every = per_suffix.agg(F.sum("n").alias("total"))
    statistics = materialise(per_suffix.crossJoin(F.broadcast(every)).select(
        "suffix", ((F.col("b") + 1) / (F.col("n") + 2)).alias("suffix_block"),
        (F.col("n") / F.col("total")).alias("suffix_share")), "suffixes")

    sample = materialise(
        with_suffix_statistics(
            labelled.orderBy(F.xxhash64("url"), "url").limit(train_rows), statistics
        ).select(*FEATURES, block.alias("label")), "urls")
    kinds = [r["label"] for r in sample.select("label").distinct().orderBy("label").collect()]
    scored = with_suffix_statistics(rows, statistics)
    if len(kinds) < 2:
        only = kinds[0] if kinds else 0.0
        judged = scored.withColumn("__p", F.lit(only))
    else:
        assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        trees = GBTClassifier(maxIter=rounds, maxDepth=depth, seed=7, cacheNodeIds=False)
        model = trees.fit(assemble.transform(sample).select("features", "label"))
        judged = scored.withColumn("__p", _score(model, FEATURES))
    by_model = F.when(F.col("__p") >= 0.5, "block").otherwise("allow")
    return judged.select(
        F.col("__key").alias(key), "host", "path", "rule",
        F.coalesce("__label", by_model).alias("verdict"), F.col("__p").alias("block_score"))


def _score(model, names: Sequence[str]) -> Column:
    """The fitted trees as nested CASE expressions over plain columns."""

    def grown(node) -> Column:
        if node.numDescendants() == 0:
            return F.lit(float(node.prediction()))
        split = node.split()
        at = F.col(names[split.featureIndex()]) <= F.lit(float(split.threshold()))
        return F.when(at, grown(node.leftChild())).otherwise(grown(node.rightChild()))

    margin = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights):
        margin = margin + F.lit(float(weight)) * grown(tree._call_java("rootNode"))
    return 1 / (1 + F.exp(-2 * margin))
