"""Quality rules: base rules on words and lines, then a hashed n-gram log-likelihood ratio against the raw corpus.

Two multinomials over hashed n-grams are counted, one from trusted documents and one from the whole corpus. A document's
score is the mean of the log ratio of its n-grams, so length plays no part. The threshold is a fixed function of the
labelled documents' scores; every document is decided by comparison, nothing is drawn at random.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import store_once

#: Fixed values of the base rules.
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class QualitySettings:
    """``cells``: hashed n-grams. ``most_words``: largest n. ``smoothing``: added to each cell's count, as a share of
    the counts' mean. ``trusted_documents``: most labelled documents that the trusted counts are made of. ``spread`` and
    ``least_spread``: see :func:`threshold`."""

    cells: int = 1 << 14
    most_words: int = 2
    smoothing: float = 0.01
    trusted_documents: int = 20_000
    spread: float = 6.0
    least_spread: float = 4.0


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), BLANKS), lambda w: w != "")


def _gram_hashes(n: int) -> Column:
    """A hash for each run of ``n`` words, from ``hashes``, which has each word's own: a word is hashed once."""
    if n == 1:
        return F.col("hashes")
    grams = F.transform("hashes", lambda h, i: F.xxhash64(h, *[F.get("hashes", i + k) for k in range(1, n)]))
    return F.slice(grams, 1, F.greatest(F.size("hashes") - n + 1, F.lit(0)))


def _covered() -> tuple[Column, Column]:
    """Places of 3-word windows found twice or more (equal ones are neighbours when sorted), and the words they cover."""
    twice = F.filter("s", lambda x, j: (F.get("s", j - 1)["h"] == x["h"]).eqNullSafe(True) | (F.get("s", j + 1)["h"] == x["h"]).eqNullSafe(True))
    places = F.array_sort(F.transform(twice, lambda x: x["i"]))
    # each place covers three words, but for those that the next place covers too
    covered = F.aggregate("places", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("end")), lambda done, p: F.struct(
        (done["n"] + F.least(F.lit(3), p - done["end"])).alias("n"), p.alias("end")))
    return places, covered


def base_figures(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (and ``hashes``) added."""
    places, covered = _covered()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.withColumn("words", words_of(F.col("text"))).withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "lines": lines,
        "hashes": F.transform("words", lambda w: F.xxhash64(w)),
    }).drop("words").withColumn("windows", _gram_hashes(3))
    several = F.size("windows") > F.size(F.array_distinct("windows"))
    paired = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    placed = counted.withColumn("s", F.when(several, paired)).withColumn("places", F.when(F.col("s").isNotNull(), places))
    full = placed.withColumns({
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": F.coalesce(F.when(F.col("places").isNotNull(), covered["n"]), F.lit(0)).cast("long"),
    })
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return full.withColumn("base_failed", failed).drop("lines", "windows", "s", "places")


def _cells(settings: QualitySettings) -> list[Column]:
    """The cells of all n-grams of ``hashes``, an array for each n up to ``most_words``."""
    return [F.transform(_gram_hashes(n), lambda h: F.pmod(h, F.lit(settings.cells)).cast("int")) for n in range(1, settings.most_words + 1)]


def gram_ratios(docs: DataFrame, trusted: DataFrame, settings: QualitySettings = QualitySettings()) -> list[float]:
    """Per cell the log of its share in trusted documents over its share in all documents; 0 without any trusted word.

    The raw counts cover every document, combined per task before the shuffle, so a hot n-gram is one row per task, and
    only ``cells`` rows reach the driver. The trusted counts cover the documents named in ``trusted`` (doc_id), of which
    ``trusted_documents`` at most are used, chosen by hash; that bounds what is broadcast.
    """
    ids = (trusted.select(F.col("doc_id").cast("long").alias("t_id")).where("t_id IS NOT NULL").distinct()
           .orderBy(F.xxhash64("t_id"), "t_id").limit(settings.trusted_documents).withColumn("trusted", F.lit(1)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = rows.join(F.broadcast(ids), rows["doc_id"] == ids["t_id"], "left")
    # hashes must be a column of their own: inside a lambda an expression is evaluated for each element
    counts = (marked.select("trusted", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))
              .select("trusted", F.explode(F.concat(*_cells(settings))).alias("cell"))
              .groupBy("cell").agg(F.count("trusted").alias("t"), F.count("*").alias("r")).collect())
    target, raw = [0.0] * settings.cells, [0.0] * settings.cells
    for row in counts:
        target[row["cell"]], raw[row["cell"]] = float(row["t"]), float(row["r"])
    if not sum(target):
        return [0.0] * settings.cells

    def shares(values: list[float]) -> list[float]:
        added = settings.smoothing * sum(values) / settings.cells
        total = sum(values) * (1 + settings.smoothing)
        return [(v + added) / total for v in values]
    return [math.log(t / r) for t, r in zip(shares(target), shares(raw))]


def likelihood_ratio(ratios: list[float], settings: QualitySettings) -> Column:
    """The mean log ratio of the n-grams of ``hashes``; 0 without words."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    cell = lambda h: F.pmod(h, F.lit(settings.cells)).cast("int")
    total = sum((F.aggregate(_gram_hashes(n), F.lit(0.0), lambda done, h: done + F.get(table, cell(h))) for n in range(1, settings.most_words + 1)), F.lit(0.0))
    grams = sum((F.greatest(F.size("hashes") - n + 1, F.lit(0)) for n in range(1, settings.most_words + 1)), F.lit(0))
    return F.when(F.size("hashes") > 0, total / grams).otherwise(F.lit(0.0))


def scored(docs: DataFrame, trusted: DataFrame, settings: QualitySettings = QualitySettings()) -> DataFrame:
    """``docs`` with the base figures and ``score``; one pass over the texts, without a shuffle."""
    score = likelihood_ratio(gram_ratios(docs, trusted, settings), settings)
    return base_figures(docs).withColumn("score", score).drop("hashes")


def threshold(scores: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()) -> float:
    """The score below which a document goes: between the labelled groups, at equal deviations from either mean, and
    never closer to the trusted mean than ``least_spread`` deviations. Without rejected labels ``spread`` deviations
    below the trusted mean; without trusted labels nothing goes. Documents that fail the base rules don't count."""
    judged = labels.select(F.col("doc_id").cast("long").alias("l_id"), "quality").where("l_id IS NOT NULL").groupBy("l_id").agg(F.min("quality").alias("quality"))
    figures = (scores.where("NOT base_failed").join(judged, F.col("doc_id") == F.col("l_id"))
               .groupBy((F.col("quality") == 1).alias("good")).agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("s")).collect())
    groups = {row["good"]: (row["m"], row["s"]) for row in figures}
    if True not in groups:
        return -math.inf
    mean, deviation = groups[True]
    if False not in groups or groups[False][0] >= mean:
        return mean - settings.spread * deviation
    other, width = groups[False]
    middle = (mean * width + other * deviation) / (width + deviation) if width + deviation else (mean + other) / 2
    return min(middle, mean - settings.least_spread * deviation)


def assess(docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score) of every row.

    ``labels`` has doc_id, quality and toxic; trusted are those of quality 1 that aren't toxic. Null and empty texts have
    no words and fail the base rules. Repeated rows and equal texts are judged alike; a null doc_id has no label. An
    empty table gives an empty table. Counts of words are of whole texts, whatever their length.
    """
    found = store_once(scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), trusted_of(labels), settings).drop("text"), "quality")
    least = threshold(found, labels, settings)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        (~F.col("base_failed") & (F.col("score") >= F.lit(least))).alias("kept"), "score")


def trusted_of(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")


def keep_good(docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()) -> DataFrame:
    """The rows of ``docs`` that :func:`assess` keeps, unchanged. Texts are read, not shuffled."""
    found = scored(docs.withColumn("row", F.struct(*docs.columns)).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text")),
                   trusted_of(labels), settings)
    held = store_once(found.select("row", "doc_id", "base_failed", "score"), "quality")
    least = threshold(held, labels, settings)
    return held.where(~F.col("base_failed") & (F.col("score") >= F.lit(least))).select("row.*")
