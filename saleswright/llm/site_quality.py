"""Quality classifier with hierarchical empirical Bayes (operator 3).

A document's own evidence is the probability of a linear classifier over the words it has and the
shape of its text. Sites say more: the good share of a path is estimated from its documents
and drawn towards its host's, the host's towards the global share. How strongly is itself
estimated from how far sites differ beyond chance (method of moments), so a site with few
documents tells little and one with many tells what it shows. A document's own evidence
is taken out of its site's before the two are combined:

    logit(score) = logit(document) + logit(path without the document) - logit(global)

The classifier is fitted on at most ``SAMPLE_ROWS`` labelled rows, chosen by hash. Sites are
counted over all documents by grouped sums, which tasks add up first.

Null and empty texts are scored by their shape. Null hosts and paths are a site of their own.
Labels that are null or without a document are not used; with too few left, or of one
class alone, every document's evidence is the share of good ones (all, without labels). Ties, repeated rows and other
columns change nothing; columns named like the results are replaced. An empty table gives
an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.llm.common import SPACE, column, fresh, text_of
from saleswright.scale import attach, settled

SAMPLE_ROWS = 20_000
# The most frequent words of the sample that at least so many of its documents have.
VOCABULARY = 1 << 15
MIN_DOCS = 3
# With fewer labelled documents nothing is fitted.
LEAST_ROWS = 10
# The sample is small, so few tasks share it; their sums go straight to the driver.
FIT_TASKS = 4
# The L1 penalty leaves the words that tell in general, not those of single documents.
REGULARISATION = 5e-4
ITERATIONS = 50
# Below one half, as losing a good document costs more than keeping a poor one.
THRESHOLD = 0.35
# The bounds of how many documents a site's prior weighs.
WEAKEST, STRONGEST = 2.0, 1e6
CERTAIN = 1e-6


def _bucket(name: str, value: Column, edges: tuple[float, ...]) -> Column:
    """A made-up word that says between which edges a measure lies."""
    number = sum((F.when(value > e, 1).otherwise(0) for e in edges), F.lit(0))
    return F.concat(F.lit(f"<{name}>"), number.cast("string"))


def evidence(text: Column) -> Column:
    """What a text has: its words, each once, and words for its shape."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1))
    chars = F.greatest(F.char_length(text), F.lit(1))
    gone = lambda pattern: F.char_length(F.regexp_replace(text, pattern, ""))
    n = F.greatest(F.regexp_count(text, F.lit(f"{SPACE}+")) + 1, F.lit(1))
    distinct = F.array_distinct(words)
    shape = F.array(
        _bucket("symbols", (F.char_length(text) - gone(r"[#*$%&|<>!]+")) / n, (0.02, 0.1, 0.3)),
        _bucket("capitals", (F.char_length(text) - gone(r"\p{Lu}+")) / chars, (0.06, 0.15, 0.5)),
        _bucket("length", n, (10, 50, 200, 1000)),
        _bucket("variety", F.size(distinct) / F.greatest(F.size(words), F.lit(1)), (0.1, 0.3, 0.5)),
    )
    return F.concat(distinct, shape)


@dataclass
class Evidence:
    """The fitted classifier, or the share of good labels where nothing could be fitted."""

    words: CountVectorizerModel | None
    model: LogisticRegressionModel | None
    share: float

    def __call__(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """Add a document's probability of being good."""
        if self.model is None:
            return df.withColumn(out, F.lit(self.share))
        names = [fresh(df.columns, n) for n in ("words", "counts", "raw", "chances", "guess")]
        words, counts, raw, chances, guess = names
        self.words.setInputCol(words).setOutputCol(counts)
        self.model.setFeaturesCol(counts).setRawPredictionCol(raw)
        self.model.setProbabilityCol(chances).setPredictionCol(guess)
        counted = self.words.transform(df.withColumn(words, evidence(text_of(text))))
        scored = self.model.transform(counted)
        return scored.withColumn(out, vector_to_array(F.col(chances))[1]).drop(*names)


def fit_evidence(
    df: DataFrame,
    labels: DataFrame,
    good: str,
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> Evidence:
    """Fit the classifier on a bounded sample of labelled documents.

    ``good`` is an SQL condition on ``labels``, which share the key with ``df``.
    """
    marks = labels.select(column(key).alias("id"), F.expr(good).cast("double").alias("label")).dropna()
    total = marks.count()
    parts = max(1, math.ceil(total / sample_rows))
    some = marks.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == 0).limit(sample_rows)
    some = settled(some.dropDuplicates(["id"]))
    # At most sample_rows rows of two numbers.
    docs = df.select(column(key).alias("id"), column(text).alias("text"))
    chosen = settled(
        docs.join(F.broadcast(some), "id").select("label", evidence(text_of("text")).alias("words"))
    )
    rows, found, share = chosen.agg(
        F.count(F.lit(1)), F.count_distinct("label"), F.avg("label")
    ).first()
    if found < 2 or rows < LEAST_ROWS:
        return Evidence(None, None, 1.0 if share is None else float(share))
    words = CountVectorizer(
        vocabSize=VOCABULARY, minDF=MIN_DOCS, binary=True, inputCol="words", outputCol="features"
    ).fit(chosen)
    learner = LogisticRegression(
        regParam=REGULARISATION, elasticNetParam=1.0, maxIter=ITERATIONS, standardization=False
    )
    counted = words.transform(chosen).select("label", "features").coalesce(FIT_TASKS)
    return Evidence(words, learner.fit(counted), float(share))


def _strength(between: float, share: float) -> float:
    """How many documents a prior weighs, from the variance of true shares."""
    spread = share * (1 - share)
    if between <= 0 or spread <= 0:
        return STRONGEST
    return min(max(spread / between - 1, WEAKEST), STRONGEST)


def _between(groups: DataFrame, centre: Column, share: float) -> float:
    """The variance of shares around a centre beyond what chance makes, over all groups."""
    n, gap = F.col("n"), F.col("good") / F.col("n") - centre
    excess, weight = groups.agg(F.sum(n * gap * gap - share * (1 - share)), F.sum(n)).first()
    return float(excess or 0.0) / float(weight or 1.0)


def site_posteriors(chances: DataFrame) -> tuple[DataFrame, float, float, float]:
    """Per host and path the sums that a posterior needs; the global share and two strengths.

    ``chances`` has the columns host, path and chance.
    """
    paths = settled(
        chances.groupBy("host", "path").agg(
            F.sum("chance").alias("good"), F.count(F.lit(1)).cast("double").alias("n")
        )
    )
    hosts = settled(
        paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    )
    good, n = hosts.agg(F.sum("good"), F.sum("n")).first()
    share = float(good) / float(n) if n else 0.5
    host_weight = _strength(_between(hosts, F.lit(share), share), share)
    joined = attach(
        paths, hosts.withColumnsRenamed({"good": "host_good", "n": "host_n"}), ["host"]
    )
    centre = (F.col("host_good") + host_weight * share) / (F.col("host_n") + host_weight)
    path_weight = _strength(_between(joined, centre, share), share)
    return settled(joined), share, host_weight, path_weight


def logit(chance: Column) -> Column:
    safe = F.greatest(F.least(chance, F.lit(1 - CERTAIN)), F.lit(CERTAIN))
    return F.log(safe / (1 - safe))


def site_scores(
    df: DataFrame,
    evidence_of: Evidence,
    host: str = "source",
    path: str = "lang",
    text: str = "text",
    threshold: float = THRESHOLD,
    settle: bool = False,
) -> DataFrame:
    """Add ``evidence``, ``site_share``, ``score`` and ``kept`` to every row.

    ``settle`` writes the rows with their evidence once instead of reading texts again; give it
    narrow rows then.
    """
    results = ("evidence", "site_share", "score", "kept")
    names = [c for c in df.columns if c.lower() not in results]
    row = fresh([text], "row")
    place = [F.coalesce(column(c).cast("string"), F.lit("\x00")) for c in (host, path)]
    packed = df.select(
        F.struct(*(column(c) for c in names if not (settle and c == text))).alias(row),
        column(text).alias("text"),
        place[0].alias("host"),
        place[1].alias("path"),
    )
    scored = evidence_of(packed, "text", "chance").drop("text")
    if settle:
        scored = settled(scored)
    sites, share, host_weight, path_weight = site_posteriors(scored.select("host", "path", "chance"))
    own, n = F.col("chance"), F.col("n")
    host_share = (F.col("host_good") - own + host_weight * share) / (
        F.col("host_n") - 1 + host_weight
    )
    path_share = (F.col("good") - own + path_weight * host_share) / (n - 1 + path_weight)
    total = logit(own) + logit(path_share) - logit(F.lit(share))
    # One row per site; sites may be too many to send, which is checked.
    joined = attach(scored, sites, ["host", "path"], computed=True)
    return joined.select(
        f"`{row}`.*",
        own.alias("evidence"),
        path_share.alias("site_share"),
        (1 / (1 + F.exp(-total))).alias("score"),
    ).withColumn("kept", F.col("score") >= threshold)


def good_sites(
    df: DataFrame,
    evidence_of: Evidence,
    host: str = "source",
    path: str = "lang",
    text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows that are kept, with the columns they came with."""
    row = fresh([host, path, text], "whole")
    parts = (column(c).alias(c) for c in dict.fromkeys((host, path, text)))
    rows = df.select(F.struct(*(column(c) for c in df.columns)).alias(row), *parts)
    scored = site_scores(rows, evidence_of, host, path, text, threshold)
    return scored.filter("kept").select(f"`{row}`.*")
