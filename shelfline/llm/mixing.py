"""Mixing sources to target weights by Pareto order sampling (DataFrame only).

Sources take a share of all words by weight, capped at ``max_copies`` times the
words they have; what a cap frees goes to the others by weight.  A document's
expected copies are target / source words.  The whole part is certain; for the
rest, documents are ranked by Pareto order, (u / (1-u)) / (p / (1-p)) with u
uniform from the id's MD5 and p the inclusion probability, and taken in rank
order while they fit into the source's remaining words.  One more document, of
those next in rank (the bucket of the cut), fills the gap if that comes nearer:
the one whose size is nearest to the gap.  So the sample has a fixed size in
words, and reruns agree.

Scale: no window runs over a source.  Ranks are cut into one bucket per
``bucket_rows`` documents; bucket sums are aggregated first, the running sum
runs over buckets, and only the bucket that holds the cut is ordered row by row.
The one-task windows run over the source table (a row per source).

Defined cases: null text has size 0; a null source is a source of its own, last
in order; documents of size 0 count no words; rows with equal ids share one
draw; an empty table gives an empty result.  Columns of ``docs`` named like an
output column are replaced by it; ``take`` gives them back as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, small

WEIGHTS, MAX_COPIES, BUCKET_ROWS, SEED = (5, 2, 1), 3, 2000, "mix"
WORD = r"[^\x20\x09-\x0D]+"
_PRE = "__mx_"
OUTPUTS = ("mix_size", "mix_source_size", "mix_target", "mix_copies")


def _sized(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: str) -> DataFrame:
    """Per row: id (string), source key, size in words, uniform draw u."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 13), 16, 10).cast("long")
    return docs.withColumns({
        _PRE + "id": key,
        _PRE + "src": F.when(F.col(source_col).isNull(), F.lit("z"))
                       .otherwise(F.concat(F.lit("a"), F.col(source_col).cast("string"))),
        _PRE + "size": F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"),
        _PRE + "u": (draw.cast("double") + 0.5) / F.lit(float(1 << 52)),
    })


def targets(sized: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES,
            bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per source: src, words n, target, certain copies, words left to
    sample, inclusion odds and number of rank buckets."""
    per = sized.groupBy(F.col(_PRE + "src").alias("src")).agg(
        F.sum(_PRE + "size").alias("n"), F.count("*").alias("docs"))
    place = (F.row_number().over(Window.orderBy("src")) - 1) % len(weights)
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1))
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("full", "src").rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("cap", F.col("n") * F.lit(float(max_copies)))
           .withColumn("full", F.col("cap") / F.col("w"))  # the level at which the source is full
           .withColumn("rate", (F.sum("n").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                       / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))))
    # the lowest level at which no source that is left is above its cap
    level = F.min(F.when(F.col("rate") <= F.col("full"), F.struct("full", "src", "rate"))).over(every)["rate"]
    per = per.withColumn("target", F.least("cap", F.coalesce(level * F.col("w"), F.col("cap"))))
    per = per.withColumn("copies", F.when(F.col("n") > 0, F.floor(F.col("target") / F.col("n")))
                         .otherwise(0).cast("long"))
    per = per.withColumn("left", F.greatest(F.col("target") - F.col("copies") * F.col("n"), F.lit(0.0)))
    p = F.when(F.col("n") > 0, F.col("left") / F.col("n")).otherwise(0.0)
    return per.select("src", "n", "target", "copies", "left", (p / (1 - p)).alias("odds"),
                      F.ceil(F.col("docs") / bucket_rows).cast("long").alias("buckets"))


def _ranked(sized: DataFrame, per: DataFrame) -> DataFrame:
    return (sized.join(per.withColumnsRenamed({c: _PRE + "s_" + c for c in per.columns})
                       .withColumnRenamed(_PRE + "s_src", _PRE + "src"), _PRE + "src")
            .withColumnRenamed(_PRE + "s_odds", _PRE + "odds")
            .withColumn(_PRE + "q", F.when(F.col(_PRE + "odds") > 0,
                                           (F.col(_PRE + "u") / (1 - F.col(_PRE + "u"))) / F.col(_PRE + "odds")))
            .withColumn(_PRE + "r", F.col(_PRE + "q") / (1 + F.col(_PRE + "q")))
            .withColumn(_PRE + "bucket", F.floor(F.col(_PRE + "r") * F.col(_PRE + "s_buckets"))))


def mix(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, bucket_rows: int = BUCKET_ROWS,
        seed: str = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` plus size, source_size, target and copies (0 .. max_copies, whole
    copies of the document that the mix takes) under the ``mix_`` prefix."""
    docs = docs.drop(*OUTPUTS)
    # the plan works on narrow rows; the documents are read once more at the end
    narrow = cut(_sized(docs.select(id_col, source_col, text_col), id_col, source_col, text_col, seed)
                 .select(_PRE + "id", _PRE + "src", _PRE + "size", _PRE + "u"))
    cuts = small(_cuts(narrow, weights, max_copies, bucket_rows))
    return _decide(_sized(docs, id_col, source_col, text_col, seed), cuts, docs.columns)


def sizes(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, bucket_rows: int = BUCKET_ROWS,
          seed: str = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """As ``mix``, with only the id column of ``docs``: the texts are read once."""
    narrow = cut(_sized(docs.select(id_col, source_col, text_col), id_col, source_col, text_col, seed)
                 .select(id_col, _PRE + "id", _PRE + "src", _PRE + "size", _PRE + "u"))
    cuts = small(_cuts(narrow, weights, max_copies, bucket_rows))
    return _decide(narrow, cuts, [id_col])


def _cuts(narrow: DataFrame, weights, max_copies: int, bucket_rows: int) -> DataFrame:
    """Per source: the plan of ``targets`` plus the last whole rank bucket taken,
    the bucket that holds the cut, the last (rank, id) taken in it in rank order
    and the (rank, id) that fills the gap."""
    per = cut(targets(narrow, weights, max_copies, bucket_rows))
    ranked = _ranked(narrow, small(per)).filter(F.col(_PRE + "q").isNotNull())
    run = Window.partitionBy("src").orderBy("bucket")
    buckets = (ranked.groupBy(F.col(_PRE + "src").alias("src"), F.col(_PRE + "bucket").alias("bucket"))
               .agg(F.sum(_PRE + "size").alias("words"), F.first(_PRE + "s_left").alias("left"))
               .withColumn("end", F.sum("words").over(run))
               .withColumn("start", F.col("end") - F.col("words")))
    edge = cut(buckets.groupBy("src").agg(
        F.max(F.when(F.col("end") <= F.col("left"), F.col("bucket"))).alias("whole"),
        F.max(F.when((F.col("start") < F.col("left")) & (F.col("end") > F.col("left")),
                     F.struct("bucket", "start"))).alias("at")))
    inside = (ranked.join(small(edge.filter("at is not null")
                                .select(F.col("src").alias(_PRE + "src"), F.col("at.bucket").alias(_PRE + "bucket"),
                                        F.col("at.start").alias(_PRE + "start"))), [_PRE + "src", _PRE + "bucket"])
              .groupBy(F.col(_PRE + "src").alias("src"), F.col(_PRE + "r").alias("r"), F.col(_PRE + "id").alias("id"))
              .agg(F.sum(_PRE + "size").alias("words"), F.first(_PRE + "s_left").alias("left"),
                   F.first(_PRE + "start").alias("start")))
    whole = Window.partitionBy("src")
    upto = F.sum("words").over(whole.orderBy("r", "id")) + F.col("start")
    fits = F.col("upto") <= F.col("left")
    inside = (inside.withColumn("upto", upto)
              .withColumn("gap", F.col("left") - F.coalesce(F.max(F.when(fits, F.col("upto"))).over(whole), F.col("start")))
              .withColumn("miss", F.abs(F.col("gap") - F.col("words"))))
    last = inside.groupBy("src").agg(
        F.max(F.when(fits, F.struct("r", "id"))).alias("last"),
        F.min(F.when(~fits & (F.col("miss") < F.col("gap")), F.struct("miss", "r", "id"))).alias("fill"))
    last = last.select("src", "last", F.when(F.col("fill").isNotNull(), F.struct("fill.r", "fill.id")).alias("fill"))
    return cut(per.join(edge, "src", "left").join(last, "src", "left")
               .select(*per.columns, "whole", F.col("at.bucket").alias("at"), "last", "fill"))


def _decide(sized: DataFrame, cuts: DataFrame, columns: list[str]) -> DataFrame:
    rows = _ranked(sized, cuts)
    s = lambda c: F.col(_PRE + "s_" + c)
    bucket, here = F.col(_PRE + "bucket"), F.struct(F.col(_PRE + "r").alias("r"), F.col(_PRE + "id").alias("id"))
    drawn = F.coalesce(bucket <= s("whole"), F.lit(False)) | F.coalesce(
        (bucket == s("at")) & (F.coalesce(here <= s("last"), F.lit(False)) | here.eqNullSafe(s("fill"))), F.lit(False))
    return rows.select(*[sized[c] for c in columns], F.col(_PRE + "size").alias("mix_size"),
                       s("n").alias("mix_source_size"), s("target").alias("mix_target"),
                       (s("copies") + drawn.cast("long")).alias("mix_copies"))


def take(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: each document as many times as it is taken."""
    own = {c: f"{_PRE}own_{c}" for c in docs.columns if c in OUTPUTS}
    mixed = mix(docs.withColumnsRenamed(own), **kw).filter("mix_copies > 0")
    copies = mixed.withColumn(_PRE + "copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    return copies.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


#: DuckDB form of op7 over ``documents``
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS id,
         CASE WHEN source IS NULL THEN 'z' ELSE 'a' || source END AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496.0::DOUBLE AS u
  FROM documents),
per AS (
  SELECT src, sum(size)::BIGINT AS n, ceil(count(*) / 2000.0::DOUBLE) AS buckets,
         CASE (row_number() OVER (ORDER BY src) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM sized GROUP BY src),
levels AS (
  SELECT *, n * 3.0::DOUBLE AS cap, n * 3.0::DOUBLE / w AS lvl FROM per),
rates AS (
  SELECT *, (sum(n) OVER () - coalesce(sum(cap) OVER (ORDER BY lvl, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
          / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY lvl, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS rate
  FROM levels),
chosen AS (SELECT rate AS height FROM rates WHERE rate <= lvl ORDER BY lvl, src LIMIT 1),
plan AS (
  SELECT src, n, buckets, least(cap, height * w) AS target,
         CASE WHEN n > 0 THEN floor(least(cap, height * w) / n) ELSE 0 END::BIGINT AS copies
  FROM rates CROSS JOIN chosen),
rest AS (
  SELECT *, greatest(target - copies * n, 0.0::DOUBLE) AS room,
         CASE WHEN n > 0 THEN greatest(target - copies * n, 0.0::DOUBLE) / n ELSE 0.0::DOUBLE END AS p
  FROM plan),
ranked AS (
  SELECT s.*, r.n, r.target, r.copies, r.room, r.buckets,
         CASE WHEN r.p > 0 THEN (u / (1 - u)) / (r.p / (1 - r.p)) END AS q
  FROM sized s JOIN rest r USING (src)),
ordered AS (
  SELECT *, q / (1 + q) AS r, floor(q / (1 + q) * buckets) AS bucket,
         sum(size) OVER (PARTITION BY src ORDER BY q / (1 + q), id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY src, q / (1 + q), id) AS same
  FROM ranked),
edges AS (
  SELECT *, min(upto - same) OVER (PARTITION BY src, bucket) < room AND max(upto) OVER (PARTITION BY src, bucket) > room AS at_cut
  FROM ordered WHERE q IS NOT NULL),
gaps AS (
  SELECT *, room - coalesce(max(CASE WHEN upto <= room THEN upto END) OVER (PARTITION BY src), min(upto - same) OVER (PARTITION BY src)) AS gap
  FROM edges WHERE at_cut),
fills AS (
  SELECT src, arg_min(id, (abs(gap - same), r, id)) AS fill FROM gaps
  WHERE upto > room AND abs(gap - same) < gap GROUP BY src)
SELECT o.doc_id, o.size, o.n AS source_size, o.target,
       (o.size * (o.copies + CASE WHEN o.q IS NOT NULL AND (o.upto <= o.room OR o.id = f.fill) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered o LEFT JOIN fills f USING (src)
"""
