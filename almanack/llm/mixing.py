"""Operator 1: mixing sources to target weights along a time-varying curriculum.

Method: every source has a weight schedule over training time 0..1, piecewise
linear.  Its integral is the source's cumulative demand; a document whose
words lie at offset ``c`` of its source's stream trains at the time at which the
demand reaches ``c``.  That inversion has a closed form per segment (a quadratic),
so positions are one native expression and the mix is a range sort by position.

Scale: the offset of a document within its source is a two-level prefix sum,
over 4096 slices of a hash order and inside a slice, so no task gets a whole source
even if one holds a third of all rows.  Only word counts move, never texts.

Null and empty texts count 0 words, very long ones all of theirs; the null source is a source of its own, last in
order; rows may repeat; an empty table gives no rows; extra columns pass :func:`mixed_documents` unread, whatever their names.  Equal weights,
targets and reruns always agree, since the order is the md5 of the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import n_words, settle, table

WEIGHTS = (1.0, 2.0, 3.0)
MAX_EPOCHS = 3
#: Relative weight at the knots of training time, per place in ``WEIGHTS``: light sources early, heavy ones late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size`` -> adds ``place`` (0-based order) and ``target`` (words).

    Targets share the sum of all sizes by weight; none is over ``max_epochs``
    times its source's size, and what is cut there is shared again by weight
    until none is above.  The fixed point is found at once: in the order of
    size per weight the cut sources are a prefix.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    placed = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("w", w)
    placed = placed.withColumn("cap", (F.col("source_size") * max_epochs).cast("long"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rated = (
        placed.withColumn("total", F.sum("source_size").over(every))
        .withColumn("cap_before", F.sum("cap").over(order) - F.col("cap"))
        .withColumn("w_left", F.sum("w").over(every) - F.sum("w").over(order) + F.col("w"))
        .withColumn("cut", (F.col("total") - F.col("cap_before")) / F.col("w_left") * F.col("w") >= F.col("cap"))
    )
    free = F.sum(F.when(~F.col("cut"), F.col("w")).otherwise(0.0)).over(every)
    left = F.col("total") - F.sum(F.when(F.col("cut"), F.col("cap")).otherwise(0)).over(every)
    return rated.withColumn("target", F.when(F.col("cut"), F.col("cap").cast("double")).otherwise(left.cast("double") * F.col("w") / free)).select("source", "source_size", "place", "target")


def _segments(knots) -> list[tuple[float, float, float, float]]:
    """(time, rate, slope, demand so far) of each segment, for a demand that adds up to 1."""
    total = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))
    out, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        out.append((t0, w0 / total, (w1 - w0) / (t1 - t0) / total, done))
        done += (t1 - t0) * (w0 + w1) / 2 / total
    return out


def training_time(share: Column, place: Column, schedules=SCHEDULES) -> Column:
    """Time at which the integrated schedule of the source at ``place`` has asked for ``share`` (0..1) of its words."""
    of_place = None
    for k, knots in enumerate(schedules):
        time = None
        for t0, rate, slope, done in _segments(knots):
            more = F.greatest(share - F.lit(done), F.lit(0.0))
            at = F.lit(t0) + F.lit(2.0) * more / (F.lit(rate) + F.sqrt(F.greatest(F.lit(rate * rate) + F.lit(2.0 * slope) * more, F.lit(0.0))))
            time = at if time is None else F.when(share >= done, at).otherwise(time)
        of_place = F.when(place % len(schedules) == k, time) if of_place is None else of_place.when(place % len(schedules) == k, time)
    return F.least(of_place, F.lit(1.0))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, schedules=SCHEDULES, row: str | None = None) -> DataFrame:
    """One row per document: ``row_id, doc_id, source, size, source_size, target, place, taken, epochs, start, position``.

    A source's stream is its documents in hash order, over and over; the mix
    takes its first ``target`` words.  ``taken`` counts them per document,
    ``epochs`` how often the document begins in the stream, ``start`` its
    offset there and ``position`` the training time of its first use.
    ``row_id`` numbers the input rows, for joining back: the column ``row`` if there is one.
    """
    base = docs.select(
        F.col("doc_id"), F.col("source"), n_words(F.col("text")).alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h"),
        F.col(row).alias("row_id") if row else F.monotonically_increasing_id().alias("row_id"),
    )
    base = settle(base, "sizes").withColumn("slice", F.substring("h", 1, 3))
    slices = base.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    before = F.sum("slice_size").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("slice_size")
    targets = source_targets(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, max_epochs)
    slices = slices.withColumn("before", before).withColumnRenamed("source", "s")
    plan = slices.join(targets, F.col("s").eqNullSafe(F.col("source"))).select("s", F.col("slice").alias("sl"), "before", "source_size", "place", "target")
    inside = F.sum("size").over(Window.partitionBy("source", "slice").orderBy("h", "doc_id", "size", "row_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    rows = base.withColumn("inside", inside).join(plan, (F.col("slice") == F.col("sl")) & F.col("source").eqNullSafe(F.col("s")))
    words = F.floor(F.col("target") + 0.5).cast("long")
    rows = rows.withColumn("start", F.col("before") + F.col("inside")).withColumn("words", words)
    rows = rows.withColumn("full", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(0)).withColumn("rest", F.col("words") - F.col("full") * F.col("source_size"))
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - F.col("start")))
    share = F.when(F.col("words") > 0, F.col("start") / F.col("words")).otherwise(0.0)
    return rows.select(
        "row_id", "doc_id", "source", "size", "source_size", "target", "place",
        (F.col("full") * F.col("size") + part).alias("taken"),
        (F.col("full") + F.when(part > 0, 1).otherwise(0)).cast("int").alias("epochs"),
        "start", "words", training_time(share, F.col("place"), schedules).alias("position"),
    )


def in_order(rows: DataFrame, position: str, *ties: str) -> DataFrame:
    """Range-sorted by position: files or partitions in turn are the training order."""
    return rows.repartitionByRange(F.col(position), *ties).sortWithinPartitions(position, *ties)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents in training order: each once per use, whole, with all its columns, range-sorted by position.

    A document whose words only begin before the end of the target is used whole.
    Documents without words belong to no demand and come first, once.
    """
    every = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc")
    kept = settle(docs.select(every).withColumn("row", F.monotonically_increasing_id()), "documents")
    plan = _uses(kept.select("row", "doc.doc_id", "doc.source", "doc.text"), options)
    out = in_order(kept.join(plan, "row").select("doc", "row", F.explode("uses").alias("use")), "use", "row")
    return out.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def _uses(rows: DataFrame, options) -> DataFrame:
    schedules = options.get("schedules", SCHEDULES)
    m = mix(rows, row="row", **options)

    def time(k: int) -> Column:
        return training_time((F.col("start") + F.lit(k) * F.col("source_size")) / F.col("words"), F.col("place"), schedules)
    uses = F.when(F.col("size") == 0, F.array(F.lit(0.0)))
    for n in range(int(options.get("max_epochs", MAX_EPOCHS)), 0, -1):
        uses = uses.when(F.col("epochs") == n, F.array(*[time(k) for k in range(n)]))
    return m.select(F.col("row_id").alias("row"), uses.alias("uses")).where(F.col("uses").isNotNull())


def op1_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 1, 2, 3 in the order of sources, range-sorted by training position."""
    placed = in_order(mix(table(spark, sf_dir, "documents")), "position", "doc_id")
    return placed.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 6).alias("position"))


OP1_SQL = r"""
WITH base AS (
  SELECT doc_id, source, length(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'x', 'g')) - length(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', '', 'g')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, 3 * source_size AS cap FROM sizes),
weighed AS (SELECT *, CAST(place % 3 + 1 AS DOUBLE) AS w, sum(source_size) OVER () AS total FROM placed),
rated AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
    sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left FROM weighed),
cuts AS (SELECT *, CAST(total - cap_before AS DOUBLE) / w_left * w >= cap AS cut FROM rated),
targets AS (
  SELECT source, source_size, place, CASE WHEN cut THEN CAST(cap AS DOUBLE)
    ELSE CAST(total - sum(CASE WHEN cut THEN cap ELSE 0 END) OVER () AS DOUBLE) * w / sum(CASE WHEN cut THEN 0.0 ELSE w END) OVER () END AS target FROM cuts),
streams AS (
  SELECT b.doc_id, b.size, t.source_size, t.place, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS words,
    CAST(sum(b.size) OVER (PARTITION BY b.source ORDER BY h, b.doc_id, b.size ROWS UNBOUNDED PRECEDING) - b.size AS BIGINT) AS start
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS whole, CASE WHEN words > 0 THEN CAST(start AS DOUBLE) / words ELSE 0.0 END AS share FROM streams)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(whole * size + greatest(0, least(size, words - whole * source_size - start)) AS BIGINT) AS taken,
  round(least(CASE place % 3 WHEN 0 THEN 2.0 * share / (1.5 + sqrt(greatest(2.25 - 2.0 * share, 0.0)))
    WHEN 1 THEN share ELSE 2.0 * share / (0.5 + sqrt(0.25 + 2.0 * share)) END, 1.0), 6) AS position
FROM parts
"""

QUERIES = {"op1_mixing_sources": op1_mixing_sources}
SQL = {"op1_mixing_sources": OP1_SQL}
