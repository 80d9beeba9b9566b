"""Mixing sources to target weights by entropy balancing.

Of all document rates r between 0 and `most` that give each source s its token target T_s, those are taken that are nearest to rate 1 in
relative entropy, a document counting by the root of its size (between one document, one voice, and one word, one voice):

    minimise  sum_i sqrt(size_i) * (r_i ln r_i - r_i + 1)   subject to  sum_{i in s} size_i r_i = T_s

so rates are exponentially tilted, r_i = min(most, exp(lambda_s * sqrt(size_i))): a source that has to shrink gives up long documents
first, and one that has to grow repeats them first. Newton's method finds lambda on the convex dual: each step sums
size_i r_i (gradient) and size_i^1.5 r_i (Hessian, of documents below the cap) over the documents and moves all sources at once. Documents of one source and
size have one rate, so the steps run over the counts of (source, size), made once with map-side sums. A step that leaves the
bracket of lambda is replaced by its middle; the steps end when all gradients are within TOLERANCE of their targets. The sums are of decimals, so
their order does not matter.

Rates become copies: each document has floor(r), and some have one more. Which: those whose key, a hash of doc_id over the
fraction of r, lies below a level of their source, at which the words so taken come nearest the target (the level would be 1
on average). The level is found digit by digit through histograms of the keys (BINS a source and digit); then, three times, the
one key whose size best makes up for the rest is added or taken out. All of this is in integers, so reruns agree.

Defined cases: null or empty text has size 0, takes 0 words and counts in its source; source null is a source of its
own, last in order, whose weight follows; a source without words has target 0; rows of equal doc_id and size
get the same number of copies; no rows, no result. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import n_words, settle, unused

TOLERANCE, STEPS, HALVED = 1e-11, 120, 30
UNIT = 1_000_000_000  # a fraction of a rate is a number of billionths
HASH_BITS, DIGIT, DIGITS = 30, 9, 4
BINS = 1 << DIGIT
LAST_KEY = (1 << DIGIT * DIGITS) - 1
BROADCAST_SOURCES = 100_000  # some 10 MB
FLIPS = 3


def ordered(df: DataFrame, order: list[Column], **sums: Column) -> DataFrame:
    """df with, for each of sums, what it comes to over the rows before a row in the given order (which has no ties).

    In two levels, the ranges of a range partitioning and the rows of a range, so no task has all rows.
    """
    df = settle(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = df.groupBy("_range").agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    ranges = ranges.select(F.col("_range").alias("_of"), *(before(F.col(n), Window.orderBy("_range")).alias(f"_{n}") for n in sums))
    within = Window.partitionBy("_range").orderBy(*order)
    out = df.withColumns({n: before(c, within) for n, c in sums.items()}).join(ranges, F.col("_range") == F.col("_of"))
    return out.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop("_range", "_of", *(f"_{n}" for n in sums))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Of source, source_size (a row for each source): place (0, 1, ... by code point, null last), target.

    Sources weigh `weights`, repeating, and share all words; a target stops at `most`
    times its source's size, the excess going to the others by weight until none is above. With c = most * size / weight
    in ascending order, a source stops exactly if c is no more than what is left for a unit of weight, and
    this holds for a prefix of that order: sums over what comes before find it without rounds.
    """
    place = [F.col("source").isNull(), F.col("source").cast("binary")]
    known = ordered(sizes, place, place=F.lit(1).cast("long"))
    known = settle(known.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long")))
    words, weight = known.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    known = ordered(known, [F.col("source_size") / F.col("weight"), F.col("place")], size_before=F.col("source_size"), weight_before=F.col("weight"))
    known = settle(known.withColumn("_stops", F.col("source_size") * most * (F.lit(weight) - F.col("weight_before")) <= (F.lit(words) - F.col("size_before") * most) * F.col("weight")))
    gone, share = known.agg(F.coalesce(F.sum(F.when(F.col("_stops"), F.col("source_size") * most)), F.lit(0)), F.sum(F.when(~F.col("_stops"), F.col("weight")))).first()
    even = F.col("weight") * (words - gone) / F.lit(share or 1)
    return known.select("place", "source", "source_size", F.when(F.col("_stops"), (F.col("source_size") * most).cast("double")).otherwise(even).alias("target"))


def rate(tilt: Column, size: Column, most: int) -> Column:
    """A document's rate; null without words or tilt."""
    return F.when(size > 0, F.least(F.lit(float(most)), F.exp(tilt * F.sqrt(size))))


def balanced(counts: DataFrame, plan: DataFrame, most: int) -> DataFrame:
    """plan with tilt (lambda) and off (what the gradient is short of 0) for each source; counts (place, size, n) are its documents.

    Newton's steps on the dual; tilt is null where nothing can or need be taken.
    """
    few = F.broadcast if plan.count() <= BROADCAST_SOURCES else (lambda x: x)
    counts = counts.where("size > 0")
    exact = lambda c: F.sum(c.cast("decimal(38,9)")).cast("double")
    mean = counts.groupBy("place").agg((exact(F.col("n") * F.col("size") * F.sqrt("size")) / F.sum(F.col("n") * F.col("size"))).alias("mean"))
    log, top = F.log(F.col("target") / F.col("source_size")), F.lit(math.log(most))
    # documents have a word or more, so lambda lies between these two
    state = plan.where((F.col("source_size") > 0) & (F.col("target") > 0)).join(mean, "place")
    state = state.select("place", "source_size", "target", F.least(F.lit(0.0), log).alias("low"), top.alias("high"), F.when(F.col("target") >= F.col("source_size") * most, top).otherwise(F.least(top, log / F.col("mean"))).alias("tilt"), F.lit(0.0).alias("off"))
    state = settle(state)
    for step in range(STEPS):
        tilted = counts.join(few(state.select("place", "tilt")), "place").withColumn("words", F.col("n") * F.col("size") * rate(F.col("tilt"), F.col("size"), most))
        below = F.when(F.exp(F.col("tilt") * F.sqrt("size")) < most, F.col("words") * F.sqrt("size")).otherwise(0.0)
        sums = tilted.groupBy("place").agg(exact(F.col("words")).alias("words"), exact(below).alias("slope"))
        now = state.drop("off").join(sums, "place").withColumn("off", F.col("words") - F.col("target"))
        now = now.withColumns({"low": F.when(F.col("off") < 0, F.col("tilt")).otherwise(F.col("low")), "high": F.when(F.col("off") > 0, F.col("tilt")).otherwise(F.col("high"))})
        newton, middle = F.col("tilt") - F.col("off") / F.col("slope"), (F.col("low") + F.col("high")) / 2
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high")) & F.lit(step < HALVED)
        done = (F.abs("off") <= F.col("target") * TOLERANCE + 1e-6) | (F.col("high") - F.col("low") < 1e-14)
        state = settle(now.select("place", "source_size", "target", "low", "high", F.when(done, F.col("tilt")).when(inside, newton).otherwise(middle).alias("tilt"), "off", done.alias("done")))
        if state.where("not done").isEmpty():
            break
        state = state.drop("done")
    return plan.join(few(state.select(F.col("place").alias("_p"), "tilt", "off")), F.col("place") == F.col("_p"), "left").drop("_p")


def _drawn(df: DataFrame, most: int) -> DataFrame:
    """Rows with size, hash and their source's tilt: base (whole copies), part (billionths of a further one), key (what the level is held against)."""
    r = F.round(rate(F.col("tilt"), F.col("size"), most), 9)
    df = df.withColumn("base", F.coalesce(F.floor(r), F.lit(0)).cast("long"))
    df = df.withColumn("part", F.coalesce(F.round((r - F.col("base")) * UNIT), F.lit(0)).cast("long"))
    return df.withColumn("key", F.when(F.col("part") > 0, F.least(F.lit(LAST_KEY), F.expr(f"hash * {UNIT} div part"))).cast("long"))


def _plan(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """source, place, source_size, target, tilt, level, flips: a row for each source of sized (source, size, hash)."""
    counts = settle(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    plan = settle(targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most))
    counts = settle(_beside(counts, plan.select("source", "place")))
    plan = settle(balanced(counts.select("place", "size", "n"), plan, most))

    # a source's row comes to its documents where sources are few, so a hot source is not dealt out by its key
    few = F.broadcast if plan.count() <= BROADCAST_SOURCES else (lambda x: x)
    whole = _drawn(counts.join(few(plan.select("place", "tilt")), "place").withColumn("hash", F.lit(0).cast("long")), most)
    whole = whole.groupBy("place").agg(F.sum(F.col("n") * F.col("size") * F.col("base")).alias("held"))
    want = F.floor(F.round(F.col("target") - F.col("held"), 3) + 0.5).cast("long")
    wants = settle(plan.join(whole, "place").select("place", want.alias("want")).where("want > 0"))
    open_ = _drawn(_beside(sized.where("size > 0"), plan.select("source", "place", "tilt")), most).where("part > 0")
    open_ = settle(open_.groupBy("place", "key").agg(F.sum("size").alias("size")))

    # the level: the key at which the sum in order of the keys reaches what is wanted, digit by digit
    at = wants.select("place", "want", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    for digit in range(DIGITS - 1, -1, -1):
        shift = DIGIT * digit
        inside = open_.join(few(at), "place").where(F.shiftright("key", shift + DIGIT) == F.col("prefix"))
        bins = inside.groupBy("place", "want", "below", F.shiftright("key", shift).alias("bin")).agg(F.sum("size").alias("in_bin"))
        upto = F.col("below") + F.sum("in_bin").over(Window.partitionBy("place").orderBy("bin"))
        bins = bins.withColumn("upto", upto).withColumn("under", F.col("upto") - F.col("in_bin")).where("under < want and upto >= want")
        at = settle(bins.select("place", "want", F.col("bin").alias("prefix"), F.col("under").alias("below"), "upto"))
        last, at = at, at.drop("upto")
    # this key or the one below, whichever sum is nearer, the lower at a tie
    lower = F.col("want") - F.col("below") <= F.col("upto") - F.col("want")
    level = settle(last.select("place", (F.col("prefix") - F.when(lower, 1).otherwise(0)).alias("level"), (F.col("want") - F.when(lower, F.col("below")).otherwise(F.col("upto"))).alias("rest"), F.array().cast("array<long>").alias("flips")))

    # then, FLIPS times, the one key that best makes up for the rest is added if words are missing, else taken out
    taken_now = (F.col("key") <= F.col("level")) != F.array_contains("flips", F.col("key"))
    for _ in range(FLIPS):
        near = open_.join(few(level.where("rest <> 0")), "place").where((taken_now == (F.col("rest") < 0)) & (F.col("size") < 2 * F.abs("rest")))
        near = near.groupBy("place").agg(F.min(F.struct(F.abs(F.col("size") - F.abs("rest")).alias("gap"), F.col("key"), F.col("size"))).alias("m"))
        level = level.join(near, "place", "left")
        level = settle(level.select("place", "level", F.coalesce(F.col("rest") - F.signum("rest").cast("long") * F.col("m.size"), F.col("rest")).alias("rest"), F.when(F.col("m").isNull(), F.col("flips")).otherwise(F.concat("flips", F.array("m.key"))).alias("flips")))

    return settle(plan.join(level.drop("rest"), "place", "left"))


def _copies() -> Column:
    """Copies of a row (base, part, key) beside its source's level."""
    extra = (F.col("key") <= F.col("level")) != F.array_contains("flips", F.col("key"))
    return F.col("base") + F.coalesce(extra, F.lit(False)).cast("long")


def _sized(docs: DataFrame) -> DataFrame:
    return settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), _hash().alias("hash")))


def _beside(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row with its source's plan; broadcast where the sources are few, else a join that a hot source may split."""
    plan = plan.withColumnRenamed("source", "_plan_source")
    few = plan.count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(plan) if few else plan, F.col("source").eqNullSafe(F.col("_plan_source"))).drop("_plan_source")


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken of docs (doc_id, text, source)."""
    sized = _sized(docs)
    out = _drawn(_beside(sized, _plan(sized, weights, most)), most).withColumn("copies", _copies())
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce(rate(F.col("tilt"), F.col("size"), most), F.lit(0.0)).alias("rate"), "copies", (F.col("size") * F.col("copies")).alias("taken"))


def copied(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The rows of docs, each as often as the mix takes it. Texts stay where they are: only a source's plan comes to them."""
    plan = _plan(_sized(docs), weights, most)
    names = {c: f"_doc_{c}" for c in docs.columns}
    rows = docs.withColumnsRenamed(names).withColumn("source", F.col("_doc_source").cast("string"))
    rows = _beside(rows, plan).withColumn("size", n_words(F.col("_doc_text"))).withColumn("doc_id", F.col("_doc_doc_id").cast("long")).withColumn("hash", _hash())
    rows = _drawn(rows, most).select(*(F.col(v).alias(k) for k, v in names.items()), F.explode(F.array_repeat(F.lit(0), _copies().cast("int"))).alias(unused(docs, "_copy")))
    return rows.select(*docs.columns)


def _hash() -> Column:
    """HASH_BITS bits of the MD5 of doc_id as text ('' for null)."""
    return F.shiftright(F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long"), 60 - HASH_BITS)


#: The same rows by DuckDB, which halves the bracket of lambda instead of taking Newton's steps.
SQL = r"""
WITH RECURSIVE sized AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT >> 30 AS hash FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, encode(source)) AS place FROM sized GROUP BY source),
weighed AS (SELECT *, (place - 1) % 3 + 1 AS weight FROM sources),
walk AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM weighed
  WINDOW o AS (ORDER BY source_size::DOUBLE / weight, place)),
stops AS (SELECT *, source_size * 3 * share <= rest * weight AS stop FROM walk),
plan AS MATERIALIZED (
  SELECT place, source, source_size, CASE WHEN stop THEN (source_size * 3)::DOUBLE ELSE
    (weight * (sum(source_size) OVER () - coalesce(sum(source_size * 3) FILTER (stop) OVER (), 0)))::DOUBLE
    / (sum(weight) FILTER (NOT stop) OVER ())::DOUBLE END AS target FROM stops),
counts AS MATERIALIZED (
  SELECT place, target, size, count(*) AS n FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
  WHERE size > 0 AND target > 0 GROUP BY ALL),
solve AS (
  SELECT 0 AS k, place, least(0.0, ln(target / source_size)) AS low, ln(3.0::DOUBLE) AS high FROM plan WHERE source_size > 0 AND target > 0
  UNION ALL
  SELECT k + 1, place, CASE WHEN g < 0 THEN tilt ELSE low END, CASE WHEN g < 0 THEN high ELSE tilt END FROM (
    SELECT s.k, place, low, high, (low + high) / 2 AS tilt, sum(n * size * least(3.0::DOUBLE, exp((low + high) / 2 * sqrt(size)))) - any_value(target) AS g
    FROM solve s JOIN counts c USING (place) WHERE s.k < 60 GROUP BY s.k, place, low, high)),
tilts AS MATERIALIZED (SELECT place, (low + high) / 2 AS tilt FROM solve WHERE k = 60),
rates AS MATERIALIZED (
  SELECT s.*, p.place, source_size, target, CASE WHEN size > 0 THEN coalesce(round(least(3.0::DOUBLE, exp(tilt * sqrt(size))), 9), 0) ELSE 0 END AS r
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source LEFT JOIN tilts t ON t.place = p.place),
parts AS (SELECT *, floor(r)::BIGINT AS base, round((r - floor(r)) * 1000000000)::BIGINT AS part FROM rates),
drawn AS MATERIALIZED (
  SELECT *, CASE WHEN part > 0 THEN least(68719476735, (hash * 1000000000) // part) END AS key FROM parts),
wants AS (
  SELECT place, floor(round(any_value(target) - sum(size * base), 3) + 0.5)::BIGINT AS want FROM drawn GROUP BY place HAVING want > 0),
keys AS (SELECT place, want, key, sum(size)::BIGINT AS size FROM drawn JOIN wants USING (place) WHERE part > 0 GROUP BY ALL),
runs AS MATERIALIZED (SELECT *, sum(size) OVER (PARTITION BY place ORDER BY key)::BIGINT AS run FROM keys),
best AS MATERIALIZED (
  SELECT place, want, arg_min(key, (abs(run - want), key)) AS level, arg_min(run, (abs(run - want), key)) AS got
  FROM (SELECT place, want, key, run FROM runs UNION ALL SELECT DISTINCT place, want, -1, 0 FROM runs) GROUP BY ALL),
s0 AS (SELECT place, level, want - got AS rest, []::BIGINT[] AS flips FROM best),
{rounds}
SELECT doc_id, size, source_size, target, size * (base + coalesce((key <= level) <> list_contains(flips, key), false)::BIGINT) AS taken
FROM drawn d LEFT JOIN s{n} b ON d.place = b.place
"""
_ROUND = """
n{k} AS MATERIALIZED (
  SELECT r.place, arg_min(key, (abs(r.size - abs(rest)), key)) AS key, arg_min(size, (abs(r.size - abs(rest)), key)) AS size
  FROM runs r JOIN s{j} b ON r.place = b.place
  WHERE rest <> 0 AND ((key <= level) <> list_contains(flips, key)) = (rest < 0) AND r.size < 2 * abs(rest) GROUP BY r.place),
s{k} AS MATERIALIZED (
  SELECT b.place, level, coalesce(rest - sign(rest) * n.size, rest) AS rest, CASE WHEN n.key IS NULL THEN flips ELSE list_append(flips, n.key) END AS flips
  FROM s{j} b LEFT JOIN n{k} n ON b.place = n.place)"""
SQL = SQL.replace("{rounds}", ",".join(_ROUND.format(k=k, j=k - 1) for k in range(1, FLIPS + 1))).replace("{n}", str(FLIPS))
