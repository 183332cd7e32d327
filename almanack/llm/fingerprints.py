"""Operator 5: document fingerprints by SpotSigs.

Method: common words of four languages are anchors.  Each content word whose
preceding word is an anchor starts a chain: that anchor, the word and the next
content word, anchors between skipped.  The distinct hashes of a text's
chains, sorted, are its fingerprint; likeness is the Jaccard coefficient of two
fingerprints.  A text without anchors (tables, lists) is signed by the chains of
all its words.  :func:`similar_pairs` partitions by set length and prunes before
it compares.

The query needs the likeness of given pairs only, so it compares those; who is like whom in a whole table is
:func:`similar_pairs`.  Everything is DataFrame and SQL functions over whole texts, however long.

Null texts count as empty; an empty fingerprint is like another only if both
texts are equal.  Rows and ids may repeat (ties go by the text), null
ids come last in descending order, an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in a is that for it as with was on are by be this an at or from he not have his they "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es "
    "le la les de et un une du que qui est pour dans par sur pas au avec "
    "el los del en y se las con por su al lo como no"
).split()
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CHAIN = 2


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once: a lambda variable over an array of one."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _chain(p: Column) -> Column:
    return F.hash(F.substring_index(p["x"], "+", -2), F.substring_index(p["y"], "+", -1))


def _pairs(d: Column) -> Column:
    following = F.slice(d, F.lit(2), F.greatest(F.size(d), F.lit(1)))
    return F.zip_with(d, following, lambda x, y: F.struct(x.alias("x"), y.alias("y")))


def _signed(pairs: Column) -> Column:
    # anchors that end a text have no content word after them
    anchored = F.transform(F.filter(pairs, lambda p: (F.instr(p["x"], "+") > 0) & ~p["x"].endswith("+")), _chain)
    plain = F.transform(F.filter(pairs, lambda p: p["x"] != ""), _chain)
    return _let(anchored, lambda a: F.when(F.size(a) > 0, a).otherwise(plain))


def signatures(text: Column) -> Column:
    """Sorted distinct chain hashes of a text, ``array<int>``; null and empty texts have none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR), lambda w: w != "")
    # every content word carries the anchors before it: "of+the+cat"
    glued = F.array_join(F.transform(words, lambda w: F.when(w.isin(ANCHORS), F.concat(w, F.lit("+"))).otherwise(F.concat(w, F.lit(" ")))), "")
    return F.array_sort(F.array_distinct(_let(_let(F.split(glued, " "), _pairs), _signed)))


def likeness(a: Column, b: Column, text_a: Column, text_b: Column) -> Column:
    """Jaccard coefficient of two fingerprints; of two empty ones, whether the texts are equal."""
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return F.when((F.size(a) == 0) & (F.size(b) == 0), (text_a == text_b).cast("double")).otherwise(_let(shared, lambda n: n / (F.size(a) + F.size(b) - n)))


def written(sigs: Column) -> Column:
    """A fingerprint as text: eight hex digits for each signature."""
    return F.array_join(F.transform(sigs, lambda s: F.lower(F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def similar_pairs(rows: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``a, b, likeness`` for pairs of rows (``id, sigs``) with Jaccard of at least ``threshold``; a < b, empty fingerprints pair with nothing.

    Rows are partitioned by set length in steps of ``1/threshold``, so only
    equal and adjacent partitions can hold partners, and only the first
    signatures of a set, the rarest in all sets first, are matched.
    Equal fingerprints are compared once, by their smallest id; the pairs are
    between such representatives, and of each copy with its representative.
    """
    step = math.log(1 / threshold)
    sized = rows.where(F.size("sigs") > 0).groupBy("sigs").agg(F.min("id").alias("rep"))
    sized = sized.withColumn("n", F.size("sigs")).withColumn("part", F.floor(F.log("n") / F.lit(step)).cast("int"))
    each = sized.select("rep", "n", "part", F.explode("sigs").alias("sig"))
    often = each.groupBy("sig").agg(F.count(F.lit(1)).alias("often"))
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("often", "sig"))
    head = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1
    probes = each.join(often, "sig").withColumn("rank", rank).where(F.col("rank") <= head).select("rep", "n", "part", "sig")
    left = probes.select(F.col("rep").alias("a0"), F.col("n").alias("na"), "sig", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    right = probes.select(F.col("rep").alias("b0"), F.col("n").alias("nb"), "sig", "part")
    near = left.join(right, ["sig", "part"]).where("a0 != b0 and nb >= na and na >= nb * %r" % threshold).select("a0", "b0").distinct()
    compared = near.join(sized.select(F.col("rep").alias("a0"), F.col("sigs").alias("sa")), "a0").join(sized.select(F.col("rep").alias("b0"), F.col("sigs").alias("sb")), "b0")
    shared = F.size(F.array_intersect("sa", "sb"))
    found = compared.withColumn("likeness", shared / (F.size("sa") + F.size("sb") - shared)).where(F.col("likeness") >= threshold - 1e-12)
    found = found.select(F.least("a0", "b0").alias("a"), F.greatest("a0", "b0").alias("b"), "likeness").distinct()
    copies = rows.join(sized.select("sigs", "rep"), "sigs").where("id != rep").select(F.col("rep").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("likeness"))
    return found.unionByName(copies.distinct())


#: Bytes of text in a range of ids, and ranges at most: beyond these ranges grow.
RANGE_BYTES, MOST_RANGES = 64 << 20, 8192


def _cuts(docs: DataFrame) -> list[int]:
    """Ids that cut the table into ranges of about ``RANGE_BYTES``, at least as many as there are shuffle partitions."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = min(MOST_RANGES, max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES)))
    cuts = docs.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 100_000)).first()[0]
    return sorted(set(cuts or []))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, sigs, next_text, next_sigs``: each document with the next in descending order of id, the last with the first.

    Ids are cut at quantiles into ranges, one shuffle deals the rows to their
    ranges, and the neighbour is a window inside the range; only one row per
    range crosses a border.
    """
    cuts = _cuts(docs)
    part = F.lit(0)
    if cuts:  # a binary search, one step per bit
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
        bounds = F.array(*map(F.lit, cuts))
        part = F.aggregate(steps, F.lit(0), lambda acc, s: F.when((acc + s <= len(cuts)) & (F.get(bounds, acc + s - 1) < F.col("doc_id")), acc + s).otherwise(acc))
    # only texts are dealt, once for both uses; signatures follow where the rows end up
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(part, F.lit(0)).alias("part")).repartition("part")
    order = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    ranged = rows.withColumn("sigs", signatures(F.col("text"))).withColumn("below", F.lag(F.struct("text", "sigs")).over(order))
    top = rows.withColumn("top", F.lead(F.lit(True)).over(order).isNull()).where("top")
    tops = top.select("part", F.struct("text", signatures(F.col("text")).alias("sigs")).alias("of"))
    # one row per range
    across = Window.orderBy("part")
    whole = Window.partitionBy()
    edge = tops.select(F.col("part").alias("p"), F.coalesce(F.lag("of").over(across), F.max_by("of", "part").over(whole)).alias("edge"))
    joined = ranged.join(edge, (F.col("part") == F.col("p")) & F.col("below").isNull(), "left")
    return joined.withColumn("next", F.coalesce("below", "edge")).select("doc_id", "text", "sigs", F.col("next.text").alias("next_text"), F.col("next.sigs").alias("next_sigs"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    n = F.col("n_chars").cast("int")
    k = F.floor(F.col("n_chars") / 3).cast("int")
    rows = with_next(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - k), F.substring(F.col("next_text"), F.lit(1), k)))
    rows = rows.withColumn("edited_sigs", signatures(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("sigs")).alias("fingerprint"), written(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs"), F.col("text"), F.col("edited")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs"), F.col("text"), F.col("next_text")).alias("near_next"),
    )


QUERIES = {"op5_document_fingerprints": op5_document_fingerprints}
SQL: dict[str, str] = {}
