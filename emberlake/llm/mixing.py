"""Mixing documents to target weights by soft membership.

A classifier learned from the labelled table gives every document a posterior over domains. Rates, nonnegative and one per
document, are then fitted so that the expected tokens of each domain, summed over rate times tokens times posterior, match
the targets. The least-squares fit is a projected gradient method whose gradient is one aggregate over the documents; a
document's rate depends on its posterior alone, so the steps are a handful of small vectors, whatever the corpus.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import store_once
from emberlake.llm.quality_rules import SYMBOLS, words_of

#: Domains and the labels that stand for them, in order.
DOMAINS = ["clean", "low", "toxic"]
DOMAIN_OF_LABEL = "CASE WHEN toxic = 1 THEN 2 WHEN quality = 0 THEN 1 WHEN quality = 1 THEN 0 END"


@dataclass(frozen=True)
class MixSettings:
    """``weights``: target share of the tokens per domain. ``labelled_documents``: bound on the documents the classifier
    learns from, chosen by hash. ``features``: most words that speak for a domain. ``significance``: least G statistic of
    such a word. ``smoothing``: added counts of documents. ``upsample``: whether a domain with fewer tokens than its target
    is repeated; if not, what there is of it is its target. ``most_rate``: upper bound of every rate, none if null.
    ``levels``: documents whose posteriors round to the same parts in so many share a rate. ``steps``: most of the fit,
    which ends when every domain is within ``tolerance`` of its own target."""

    weights: dict[str, float] = field(default_factory=lambda: {"clean": 0.97, "low": 0.02, "toxic": 0.01})
    labelled_documents: int = 20_000
    features: int = 32
    significance: float = 10.8
    smoothing: float = 0.5
    upsample: bool = True
    most_rate: float | None = None
    levels: int = 200
    steps: int = 300
    tolerance: float = 2e-3


@dataclass
class DomainModel:
    """Log odds of each domain against domain 0. ``base``: of a document without any known word. ``weights[d]``: what each
    known word, by hash, adds for domain d."""

    base: list[float]
    weights: list[dict[int, float]]


def _seen(words: Column, text: Column) -> Column:
    """Hashes of the lower-cased words, and of three words about the text: its length, variety and share of symbols."""
    n = F.size(words)
    about = [("n", F.floor(F.log2(n + 1))), ("d", F.floor(8 * F.size(F.array_distinct(words)) / F.greatest(n, F.lit(1)))),
             ("s", F.floor(F.log2(1 + 64 * F.regexp_count(text, F.lit(SYMBOLS)) / F.greatest(n, F.lit(1)))))]
    return F.concat(F.transform(words, lambda w: F.xxhash64(F.lower(w))),
                    F.array(*[F.xxhash64(F.concat(F.lit(f" {name}"), value.cast("string"))) for name, value in about]))


def _with_seen(rows: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return rows.withColumn("words", words_of(F.col("text"))).withColumn("seen", _seen(F.col("words"), text))


def _surprise(ours: Column, theirs: Column, n: float, m: float) -> Column:
    """G statistic of a word that ``ours`` of n documents of a domain hold, and ``theirs`` of m others."""
    part = lambda seen, expected: F.when(seen > 0, 2 * seen * F.ln(seen / expected)).otherwise(F.lit(0.0))
    both = ours + theirs
    return (part(ours, both * n / (n + m)) + part(theirs, both * m / (n + m))
            + part(n - ours, (n + m - both) * n / (n + m)) + part(m - theirs, (n + m - both) * m / (n + m)))


def learn_domains(docs: DataFrame, labels: DataFrame, settings: MixSettings = MixSettings()) -> DomainModel:
    """Naive Bayes over the presence of the words that speak for a domain, each against domain 0.

    It learns from at most ``labelled_documents`` labelled documents, whose ids are broadcast. Counted are documents, not
    occurrences, so long texts weigh no more. A domain is told by the ``features`` words with the largest G statistic
    among those more frequent in it; only these reach the driver. Labels without a domain or an id teach nothing; of
    several for one document the highest domain counts. A domain without documents has next to no prior.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("l_id"), F.expr(DOMAIN_OF_LABEL).alias("domain"))
             .where("l_id IS NOT NULL AND domain IS NOT NULL").groupBy("l_id").agg(F.max("domain").alias("domain"))
             .orderBy(F.xxhash64("l_id"), "l_id").limit(settings.labelled_documents))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    learned = _with_seen(texts.join(F.broadcast(known), texts["doc_id"] == known["l_id"]))
    held = F.explode(F.concat(F.array(F.lit(None).cast("long")), F.array_distinct("seen"))).alias("word")
    counts = store_once(learned.select("domain", held).groupBy("word").agg(
        *[F.count_if(F.col("domain") == d).cast("double").alias(f"c{d}") for d in range(len(DOMAINS))]), "words")
    whole = counts.where("word IS NULL").first()
    n = [whole[f"c{d}"] if whole else 0.0 for d in range(len(DOMAINS))]
    priors = [math.log((x + 0.01) / (sum(n) + 0.01 * len(DOMAINS))) for x in n]
    base, weights = [0.0] * len(DOMAINS), [{} for _ in DOMAINS]
    for d in range(1, len(DOMAINS)):
        base[d] = priors[d] - priors[0]
        if not n[d] or not n[0]:
            continue
        ours, others = F.col(f"c{d}"), F.col("c0")
        told = (counts.where(F.col("word").isNotNull() & (ours / n[d] > others / n[0]))
                .select("word", ours.alias("ours"), others.alias("others"), _surprise(ours, others, n[d], n[0]).alias("g"))
                .where(F.col("g") >= settings.significance).orderBy(F.desc("g"), "word").limit(settings.features))
        for row in told.collect():
            p, q = ((x + settings.smoothing) / (of + 2 * settings.smoothing) for x, of in ((row["ours"], n[d]), (row["others"], n[0])))
            absent = math.log((1 - p) / (1 - q))
            base[d] += absent
            weights[d][row["word"]] = math.log(p / q) - absent
    return DomainModel(base, weights)


def with_posteriors(rows: DataFrame, model: DomainModel, settings: MixSettings = MixSettings()) -> DataFrame:
    """``rows`` (with a column text) with n_tokens, p (the posterior per domain) and bin (the rounded one); in one pass, no shuffle."""
    every = sorted({word for weights in model.weights for word in weights})
    listed = F.array(*[F.lit(w).cast("long") for w in every]).cast("array<bigint>")
    counted = _with_seen(rows).withColumn("hits", F.array_intersect("seen", listed))

    def odds(d: int) -> Column:
        table = F.array(*[F.lit(model.weights[d].get(w, 0.0)) for w in every]).cast("array<double>")
        return F.aggregate("hits", F.lit(model.base[d]), lambda done, word: done + F.get(table, F.array_position(listed, word).cast("int") - 1))

    logits = counted.withColumns({f"_logit{d}": odds(d) for d in range(1, len(DOMAINS))})
    names = [F.lit(0.0), *[F.col(f"_logit{d}") for d in range(1, len(DOMAINS))]]
    top = logits.withColumn("_top", F.greatest(*names))
    parts = [F.exp(x - F.col("_top")) for x in names]
    shares = [x / sum(parts[1:], parts[0]) for x in parts]
    return top.withColumns({"n_tokens": F.size("words").cast("long"), "p": F.array(*shares), "bin": bin_of(shares[1:], settings)}).drop(
        "words", "seen", "hits", "_top", *[f"_logit{d}" for d in range(1, len(DOMAINS))])


def bin_of(shares: list[Column], settings: MixSettings) -> Column:
    """Which documents share a rate: those of like posteriors. The first domain's share follows from the others."""
    code = F.lit(0)
    for x in shares:
        code = code * (settings.levels + 1) + F.round(x * settings.levels).cast("int")
    return code


def fit_rates(members: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """(bin, rate): accelerated projected gradient descent from rate 1, over all of ``members`` (n_tokens, p, bin).

    Minimised is the squared distance between expected and target tokens per domain, each measured by its target. The
    total is what leaves the domain with the largest weight at its present size. The members of a bin share a rate, and
    the bin carries the sums of their own tokens and posteriors, so expected totals are those of the unrounded
    posteriors. There are at most (``levels`` + 1) ** (domains - 1) bins, whatever the input. Each step is one pass over
    the bins, and one number a domain comes back. Where bounded rates can't meet a target, it ends when a step no longer
    moves any total. No tokens: no bins.
    """
    k, weights = len(DOMAINS), [settings.weights[d] for d in DOMAINS]
    p = [F.get("p", F.lit(d)) for d in range(k)]
    bins = store_once(members.groupBy("bin").agg(F.sum("n_tokens").cast("double").alias("t"), *[F.sum(F.col("n_tokens") * p[d]).alias(f"t{d}") for d in range(k)])
                      .where("t > 0").coalesce(1), "mixture")
    own = [F.col(f"t{d}") for d in range(k)]
    first = bins.agg(F.sum("t").alias("all"), *[F.sum(own[d]).alias(f"s{d}") for d in range(k)],
                     *[F.sum(own[i] * own[j] / F.col("t")).alias(f"m{i}_{j}") for i in range(k) for j in range(k)]).first()
    if not first["all"]:
        return bins.select("bin", F.lit(1.0).alias("rate"))
    main = max(range(k), key=lambda d: weights[d])
    target = [first[f"s{main}"] / weights[main] * w for w in weights]
    if not settings.upsample:
        target = [min(t, first[f"s{d}"]) for d, t in enumerate(target)]
    scale = [1 / t if t > 0 else 0.0 for t in target]  # a domain without target is left alone
    # a bin of t tokens and mean posteriors q moves by q . pull; the step fits the largest eigenvalue of the scaled moments
    matrix = [[first[f"m{i}_{j}"] * scale[i] * scale[j] for j in range(k)] for i in range(k)]
    vector, largest = [1.0] * k, 1.0
    for _ in range(100):
        vector = [sum(a * b for a, b in zip(row, vector)) for row in matrix]
        largest = max(map(abs, vector)) or 1.0
        vector = [v / largest for v in vector]
    bounded = lambda x: F.greatest(F.lit(0.0), x if settings.most_rate is None else F.least(F.lit(float(settings.most_rate)), x))
    kind = "array<struct<push:double,pull:array<double>>>"

    def walked(pulls: list[tuple[float, list[float]]]) -> Column:
        """A bin's rate after these steps, and the point from which the next one would go."""
        table = F.from_json(F.lit(json.dumps([{"push": push, "pull": pull} for push, pull in pulls])), kind)
        moved = lambda done, s: bounded(done["at"] - sum((F.get(s["pull"], F.lit(d)) * own[d] / F.col("t") for d in range(k)), F.lit(0.0)))
        return F.aggregate(table, F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("at")), lambda done, s: F.struct(
            moved(done, s).alias("rate"), (moved(done, s) * (1 + s["push"]) - done["rate"] * s["push"]).alias("at")))

    pulls: list[tuple[float, list[float]]] = []
    before: list[float] = []
    for i in range(settings.steps):
        sums = bins.withColumn("at", walked(pulls)["at"]).agg(*[F.sum(own[d] * F.col("at")).alias(f"s{d}") for d in range(k)]).first()
        miss = [(sums[d] - target[d]) * scale[d] for d in range(k)]
        stalled = before and max(abs(x - y) for x, y in zip(miss, before)) < settings.tolerance / 1000
        if max(map(abs, miss)) < settings.tolerance or stalled:
            break
        before = miss
        pulls.append((i / (i + 3), [m * s / (1.05 * largest) for m, s in zip(miss, scale)]))
    return bins.select("bin", walked(pulls)["rate"].alias("rate"))


def with_rates(members: DataFrame, rates: DataFrame, key: Column) -> DataFrame:
    """``members`` with rate, and copies: the rate rounded down or up by a draw that ``key`` alone decides. The bins are
    broadcast; their number is bounded, see :func:`fit_rates`."""
    draw = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1_000_000)) / 1_000_000
    rated = members.join(F.broadcast(rates.select(F.col("bin").alias("_bin"), F.round("rate", 6).alias("rate"))), F.col("bin") == F.col("_bin"), "left")
    return (rated.withColumn("rate", F.coalesce("rate", F.lit(1.0))).withColumn("copies", F.floor(F.col("rate") + draw).cast("long"))
            .drop("_bin", "bin"))


def mixture(docs: DataFrame, labels: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """(doc_id, n_tokens, p_clean, p_low, p_toxic, rate, copies) for every row of ``docs`` (doc_id, text).

    Null and empty texts have no tokens; their posterior is the prior. Repeated rows are alike, but each has its tokens.
    Without labels all domains are as likely, and a null doc_id has no label. An empty table gives an empty table.
    """
    model = learn_domains(docs, labels, settings)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    members = store_once(with_posteriors(rows, model, settings).withColumn("key", F.xxhash64("doc_id", "text")).drop("text"), "members")
    rated = with_rates(members, fit_rates(members, settings), F.col("key"))
    return rated.select("doc_id", "n_tokens", *[F.get("p", F.lit(d)).alias(f"p_{name}") for d, name in enumerate(DOMAINS)], "rate", "copies")


def resample(docs: DataFrame, labels: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """The rows of ``docs``, unchanged, each as often as its copies say. Texts are stored once, not shuffled; without that
    the posterior would be worked out anew within each step of the rate."""
    model = learn_domains(docs, labels, settings)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    members = store_once(with_posteriors(rows, model, settings).withColumn("key", F.xxhash64("doc_id", "text")).select("row", "n_tokens", "p", "bin", "key"), "members")
    rated = with_rates(members, fit_rates(members.select("n_tokens", "p", "bin"), settings), F.col("key")).where("copies > 0")
    return rated.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
