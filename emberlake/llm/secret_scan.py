"""Secret scans: certain kinds on their own, weak ones only together with the parts that make them a credential.

Keyword assignments, access identifiers and long hex strings are reported wherever they stand. User names, bare
base64-like strings and endpoints are weak: alone they are mostly harmless. They are reported when, within the same scope
of a text, a complementary part stands near enough: an identifier needs a secret, a secret an identifier, an endpoint
both. Parts meet by an interval join on the text and on bins as wide as the scope, never by all pairs of a text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import store_once, text_key

#: Kinds in the order in which spans of one start are listed, with their patterns.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{12,}",  # what matches but is shorter holds no other match either
    "hex": r"[0-9a-f]{32,}",
    "ident": r"""(?i)(?:user(?:name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[a-z0-9_.@+-]{3,}""",
    "blob": r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[0-9])[A-Za-z0-9+/]{32,}={0,2}(?![A-Za-z0-9+/=_-])",
    "endpoint": r"(?i)https?://[a-z0-9.-]+(?::[0-9]+)?",
}
BASE = ["assign", "access", "hex"]
LEAST_VALUE = 8
#: What each kind is to the others.
PARTS = {"assign": "secret", "access": "identifier", "hex": "secret", "ident": "identifier", "blob": "secret", "endpoint": "endpoint"}
NEEDS = {"ident": ["secret"], "blob": ["identifier"], "endpoint": ["identifier", "secret"]}


@dataclass(frozen=True)
class ScanSettings:
    """``scope``: most code points between two parts of one credential."""

    scope: int = 200


def _pieces(text: Column, kind: str) -> Column:
    """(gap, size, value) of all matches, leftmost and not overlapping: how much lies between the match before and this
    one, its length, its value's length. Most texts have no match and are seen once only."""
    pattern = PATTERNS[kind]
    lengths = lambda strings: F.transform(strings, lambda x: F.length(x))
    found = lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    value = lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(2))) if kind == "assign" else F.transform(found, lambda x: F.lit(LEAST_VALUE))
    pairs = F.arrays_zip(lengths(F.split(text, pattern, -1)).alias("gap"), found.alias("size"), value.alias("value"))
    return F.when(text.rlike(pattern), F.filter(pairs, lambda p: p["size"].isNotNull())).otherwise(
        F.array().cast("array<struct<gap:int,size:int,value:int>>"))


def _ordered(spans: Column) -> Column:
    """By start, then kind as listed, then end."""
    rank = F.array(*[F.lit(k) for k in PATTERNS])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _shown(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, text_key, at) and for each kind the lengths of its matches and of what lies between, stored; ``keep``:
    further columns behind them.

    ``at`` names a row. This is the only pass over the texts, which are neither shuffled nor, unless kept, stored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep)
    return store_once(rows.select("doc_id", text_key().alias("text_key"), F.monotonically_increasing_id().alias("at"),
                                  *[_pieces(text, kind).alias(kind) for kind in PATTERNS], *keep), "measured")


def find_parts(measured: DataFrame) -> DataFrame:
    """(at, kind, start, end, has_weak): the parts of every measured text.

    Places are running sums of gaps and lengths, taken by a window over the matches of one row and kind, so that many
    matches in one text cost no more than as many in many texts. Only numbers are shuffled. A null text has no parts.
    """
    def named(kind: str) -> Column:
        return F.transform(kind, lambda p, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), p["gap"].alias("gap"), p["size"].alias("size"), p["value"].alias("value")))

    weak = F.greatest(*[F.size(kind) for kind in NEEDS]) > 0
    each = measured.select("at", weak.alias("has_weak"), F.explode(F.concat(*[named(kind) for kind in PATTERNS])).alias("p")).select("at", "has_weak", "p.*")
    so_far = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("at", "kind").orderBy("pos"))
    return (each.withColumn("end", so_far.cast("int")).where(F.col("value") >= LEAST_VALUE)
            .select("at", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "has_weak"))


def link_parts(found: DataFrame, settings: ScanSettings = ScanSettings()) -> DataFrame:
    """(at, kind, start, end): the weak parts among ``found`` whose complementary parts stand within the scope.

    The interval join is on row and bin: a weak part is in all bins that its scope touches, from before its start to
    behind its end, any other part in the bins it covers itself. A bin holds a bounded number of parts because each has
    several characters. Parts that a base part covers are not reported again; a covering part is in the bin of the
    covered one's start.
    """
    width = settings.scope
    role = F.create_map(*[F.lit(x) for pair in PARTS.items() for x in pair])
    parts = found.where("has_weak").select("at", "kind", "start", "end", F.element_at(role, F.col("kind")).alias("role"))
    bins = lambda first, last: F.explode(F.expr(f"sequence(CAST(greatest({first}, 0) div {width} AS int), CAST(({last}) div {width} AS int))"))
    near = parts.select(F.col("at").alias("t"), "kind", F.col("role").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"),
                        bins("start", "end").alias("b"))
    met = (F.col("at") == F.col("t")) & (F.col("bin") == F.col("b"))
    linked = None
    for kind, needs in NEEDS.items():
        weak = parts.where(F.col("kind") == kind).select("at", "kind", "start", "end")
        for need in needs:
            weak = weak.withColumn("bin", bins(f"start - {width}", f"end + {width}")).join(
                near.where(F.col("r") == need).drop("kind"),
                met & (F.col("s") - F.col("end") <= width) & (F.col("start") - F.col("e") <= width), "left_semi").drop("bin").distinct()
        linked = weak if linked is None else linked.unionByName(weak)
    covering = near.where(F.col("kind").isin(BASE)).drop("kind")
    return (linked.withColumn("bin", F.expr(f"CAST(start div {width} AS int)"))
            .join(covering, met & (F.col("s") <= F.col("start")) & (F.col("end") <= F.col("e")), "left_anti").drop("bin"))


def _spans(measured: DataFrame, settings: ScanSettings) -> DataFrame:
    """(t, found): the unordered spans of each measured text that has any, by the ``at`` of its row."""
    parts = store_once(find_parts(measured), "parts")
    return (parts.where(F.col("kind").isin(BASE)).select("at", "kind", "start", "end").unionByName(link_parts(parts, settings))
            .groupBy(F.col("at").alias("t")).agg(F.collect_list(F.struct("kind", "start", "end")).alias("found")))


def _may_have_spans() -> Column:
    """Of a measured row. Base parts need a value of some length, and without one weak parts need another weak one: endpoints
    need what the others are."""
    long_enough = [F.exists(kind, lambda p: p["value"] >= LEAST_VALUE) for kind in BASE]
    return F.coalesce(reduce(Column.__or__, long_enough) | ((F.size("ident") > 0) & (F.size("blob") > 0)), F.lit(True))


def scan(docs: DataFrame, settings: ScanSettings = ScanSettings()) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked, found) for every row of ``docs`` (doc_id, text).

    ``found`` lists all spans (kind, start, end; code points, end exclusive) by start; ``spans`` is the same as text. Null
    and empty texts have none. Rows of one doc_id and other texts are kept apart; repeated rows come back as often as
    they came. An empty table gives an empty one. Texts are read whole and not shuffled: only places are, and only texts
    with weak parts take part in the join. Rows are told apart by a number that their task gives them before they are stored.
    """
    held = measure(docs)
    spans = _spans(held, settings)
    base = F.filter("found", lambda s: s["kind"].isin(BASE))
    found = held.select("doc_id", "text_key", "at").join(spans, F.col("at") == F.col("t"), "left").withColumn(
        "found", _ordered(F.coalesce("found", F.array().cast("array<struct<kind:string,start:int,end:int>>")))).withColumn("base", base)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", "text_key", *[count(k) for k in BASE], F.sha2(_shown(F.col("base")), 256).alias("base_sha256"),
                        _shown(F.col("found")).alias("spans"), (F.size("found") - F.size("base")).cast("long").alias("n_linked"), "found")


def redact(docs: DataFrame, settings: ScanSettings = ScanSettings()) -> DataFrame:
    """``docs`` with every found span replaced by ``[kind]``; overlapping spans are one, named after the first.

    ``n_chars``, if there is such a column, is counted anew for changed texts. Columns and their order stay. Rows are stored
    with their lengths; those that can have no span are not shuffled.
    """
    held = measure(docs.withColumn("row", F.struct(*docs.columns)), "row")
    joined = (held.where(_may_have_spans()).select("row", "at", F.col("row")["text"].cast("string").alias("text"))
              .join(_spans(held, settings), F.col("at") == F.col("t"), "left").withColumn("found", _ordered(F.col("found"))))
    walked = F.aggregate("found", F.struct(F.lit("").alias("text"), F.lit(0).alias("at")), lambda done, s: F.struct(
        F.when(s["start"] >= done["at"], F.concat(
            done["text"], F.substring(F.col("text"), done["at"] + 1, s["start"] - done["at"]), F.lit("["), s["kind"], F.lit("]"))).otherwise(done["text"]).alias("text"),
        F.greatest(done["at"], s["end"]).alias("at")))
    done = joined.withColumn("walked", F.when(F.col("found").isNotNull(), walked)).withColumn(
        "clean", F.concat("walked.text", F.substring(F.col("text"), F.col("walked.at") + 1, F.lit(2**31 - 1))))
    new = {"text": F.coalesce("clean", "text"), "n_chars": F.when(F.col("clean").isNotNull(), F.length("clean")).otherwise(F.col("row")["n_chars"]) if "n_chars" in docs.columns else None}
    changed = done.select(*[(new[c].cast(docs.schema[c].dataType) if c in new else F.col("row")[c]).alias(c) for c in docs.columns])
    return held.where(~_may_have_spans()).select("row.*").unionByName(changed)
