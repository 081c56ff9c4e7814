"""Mixing sources to target weights with soft membership, in DataFrame operations alone.

A naive Bayes classifier over hashed words is fitted to a table of labelled documents and gives every document a posterior
over the domains; the evidence of a document is tempered, so that membership stays soft. Document rates then solve a
non-negative least-squares problem: the expected tokens of each domain, rates times tokens times posteriors, should equal the
targets. The solver is projected gradient descent from rate one. A step moves a document's rate by the posterior-weighted
residuals of its domains and cuts it off at zero, so a rate is an expression over the posterior and the residuals so far:
each step is one aggregation of as many sums as there are domains, and only these reach the driver.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.llm import scratch

#: Hashed words, and bounds: labelled rows for the fit (smallest hashes of the id first), and domains.
BUCKETS, FIT_ROWS, DOMAINS = 4_096, 12_000, 64
SMOOTHING, EVIDENCE, STEPS, CLOSE = 0.5, 48.0, 40, 1e-3
WORD_END = r"[\s]+"


def _words(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """A row for each word with its bucket; texts without words have none."""
    word = F.explode(F.split(F.lower(F.col(text_col).cast("string")), WORD_END))
    return docs.select(F.col(id_col).alias("__id"), *more, word.alias("__word")).where(F.col("__word") != "").select("__id", *more, F.pmod(F.xxhash64("__word"), F.lit(BUCKETS)).alias("__bucket"))


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", rows: int = FIT_ROWS) -> tuple[list[str], list[float], DataFrame]:
    """The domains in order, their log priors, and a table (bucket, w0, w1, ...) of log shares by domain.

    ``labelled`` holds (id_col, domain_col); rows with a null in either are left out, and an id with several domains counts
    with the smallest. Without labelled rows there is one domain, 'none'.
    """
    spark = docs.sparkSession
    ids = labelled.where(F.col(id_col).isNotNull() & F.col(domain_col).isNotNull()).groupBy(F.col(id_col).alias("__key")).agg(F.min(F.col(domain_col).cast("string")).alias("__domain"))
    ids = F.broadcast(ids.orderBy(F.xxhash64("__key"), "__key").limit(rows))  # bounded by ``rows``
    sample = docs.join(ids, docs[id_col] == ids["__key"]).select(F.col("__key"), docs[text_col].alias("__text"), "__domain")
    sample = scratch.keep(sample, "mixing-sample")
    sizes = {r["__domain"]: r["n"] for r in sample.groupBy("__domain").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "__domain").limit(DOMAINS + 1).collect()}
    if len(sizes) > DOMAINS:
        raise ValueError(f"more than {DOMAINS} domains")
    names = sorted(sizes) or ["none"]
    total = sum(sizes.values())
    counts = _words(sample, "__key", "__text", "__domain").groupBy("__bucket").agg(*(F.count_if(F.col("__domain") == name).alias(f"c{k}") for k, name in enumerate(names)))
    every = spark.range(BUCKETS).withColumnRenamed("id", "__bucket").join(counts, "__bucket", "left").na.fill(0)
    every = scratch.keep(every, "mixing-counts")  # BUCKETS rows
    sums = every.agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(len(names)))).first()
    weights = every.select("__bucket", *(F.log((F.col(f"c{k}") + SMOOTHING) / (sums[f"c{k}"] + SMOOTHING * BUCKETS)).alias(f"w{k}") for k in range(len(names))))
    return names, [log((sizes.get(n, 0) + 1) / (total + len(names))) for n in names], weights


def posteriors(docs: DataFrame, model: tuple[list[str], list[float], DataFrame], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tokens long, p0, p1, ...): words and posterior of each id; a text without words has the prior.

    Rows that repeat an id count as one document, as do all rows without an id.
    """
    names, priors, weights = model
    sums = _words(docs, id_col, text_col).join(F.broadcast(weights), "__bucket").groupBy("__id").agg(F.count("*").alias("tokens"), *(F.sum(f"w{k}").alias(f"s{k}") for k in range(len(names))))
    seen = docs.select(F.col(id_col).alias("id")).distinct()
    joined = seen.join(sums, seen["id"].eqNullSafe(sums["__id"]), "left")
    tokens = F.coalesce("tokens", F.lit(0))
    logits = [F.lit(p) + F.coalesce(F.col(f"s{k}") / F.col("tokens") * EVIDENCE, F.lit(0.0)) for k, p in enumerate(priors)]
    joined = joined.select("id", tokens.alias("tokens"), *(x.alias(f"l{k}") for k, x in enumerate(logits)))
    top = F.greatest(*(F.col(f"l{k}") for k in range(len(names)))) if len(names) > 1 else F.col("l0")
    joined = joined.select("id", "tokens", *(F.exp(F.col(f"l{k}") - top).alias(f"e{k}") for k in range(len(names))))
    total = reduce(Column.__add__, (F.col(f"e{k}") for k in range(len(names))))
    return joined.select("id", "tokens", *((F.col(f"e{k}") / total).alias(f"p{k}") for k in range(len(names))))


def tempered(shares: list[float], power: float) -> list[float]:
    """Targets between the shares as they are (power 1) and equal ones (power 0)."""
    raised = [s**power if s > 0 else 0.0 for s in shares]
    return [x / (sum(raised) or 1.0) for x in raised]


def rates(soft: DataFrame, domains: int, targets: list[float] | None = None, power: float = 0.7, keep_all: bool = False, steps: int = STEPS) -> tuple[DataFrame, dict[str, list[float] | bool]]:
    """``soft`` with a column ``rate``, and the shares, targets and expected totals, each as a share of all tokens, and whether
    the totals came near enough before the steps ran out (``converged``).

    ``targets`` are weights of the domains (default: their shares to ``power``, see :func:`tempered`); expected totals should
    be these weights times the tokens there are, or, with ``keep_all``, times as many more that no domain must shrink. Steps
    end when every domain is within ``CLOSE`` of its target, relative to the larger of target and share, or after ``steps``.
    A domain without tokens cannot be raised and is left out of its target.
    """
    names = [f"p{k}" for k in range(domains)]
    first = soft.agg(F.sum("tokens").alias("n"), *(F.sum(F.col("tokens") * F.col(p)).alias(p) for p in names)).first()
    n = float(first.n or 0)
    shares = [float(first[p] or 0) / n if n else 0.0 for p in names]
    weights = targets or tempered(shares, power)
    weights = [w if s > 0 else 0.0 for w, s in zip(weights, shares, strict=True)]
    weights = [w / (sum(weights) or 1.0) for w in weights]
    scale = max([s / w for s, w in zip(shares, weights, strict=True) if w > 0], default=1.0) if keep_all else 1.0
    goal = [w * scale for w in weights]
    rate, reached = F.lit(1.0), shares

    def near() -> bool:
        return not n or all(abs(a - g) <= CLOSE * max(g, s, 1e-9) for a, g, s in zip(reached, goal, shares, strict=True))

    for _ in range(steps):
        if near():
            break
        off = [a - g for a, g in zip(reached, goal, strict=True)]
        move = reduce(Column.__add__, (F.col(p) * F.lit(o / s) for p, o, s in zip(names, off, shares, strict=True) if s > 0))
        rate = F.greatest(F.lit(0.0), rate - move)
        got = soft.agg(*(F.sum(F.col("tokens") * F.col(p) * rate).alias(p) for p in names)).first()
        reached = [float(got[p] or 0) / n for p in names]
    return soft.withColumn("rate", rate), {"shares": shares, "targets": goal, "reached": reached, "converged": near()}


def copies(rate: Column, id_: Column) -> Column:
    """A whole number of copies with the rate as its mean: the same for one id in every run."""
    drawn = F.pmod(F.xxhash64(F.lit("copies"), id_), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + drawn).cast("int")


def mixed(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", targets: dict[str, float] | None = None, power: float = 0.7, keep_all: bool = False) -> tuple[DataFrame, dict[str, list]]:
    """(id, tokens, p0, ..., rate, copies) for every id of ``docs``, and a report with the domains' names.

    Null and empty texts have no tokens and rate about one. With ``keep_all`` every id has one copy at least. An empty table
    gives an empty result.
    """
    model = fit(docs, labelled, id_col, text_col, domain_col)
    soft = scratch.keep(posteriors(docs, model, id_col, text_col), "mixing-posteriors")
    wanted = [targets.get(n, 0.0) for n in model[0]] if targets else None
    made, report = rates(soft, len(model[0]), wanted, power, keep_all)
    count = copies(F.col("rate"), F.col("id").cast("string"))
    return made.withColumn("copies", F.greatest(count, F.lit(1)) if keep_all else count), report | {"domains": model[0]}


def resampled(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:  # noqa: ANN003
    """Pipeline form: each row of ``docs`` as often as its document's copies say, with its columns."""
    made, _ = mixed(docs, labelled, id_col, text_col, **how)
    times = made.select(F.col("id").alias("__mix_id"), F.col("copies").alias("__copies")).where("__copies > 0")
    joined = docs.join(times, docs[id_col].eqNullSafe(times["__mix_id"]))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*(docs[c] for c in docs.columns))


def language_and_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labelled table for the queries: (id_col, domain), a document's language with its quality label."""
    named = docs.select(F.col(id_col), F.coalesce(F.col("lang").cast("string"), F.lit("none")).alias("__lang"))
    marked = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("__labelled")).agg(F.min("quality").alias("__quality"))
    return named.join(marked, named[id_col] == marked["__labelled"]).select(id_col, F.concat_ws("/", "__lang", F.col("__quality").cast("string")).alias("domain"))
