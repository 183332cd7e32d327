"""What the operators of this subpackage share: shared-folder tables and components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value of the word definition: runs of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where that is unset (tests on one machine) a temporary folder is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="almanack-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: Python workers import it wherever they run.

    Arrow batches are made smaller than by default, as rows hold whole texts.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="almanack-")) / f"{package.name}_llm.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in [package / "__init__.py", *sorted((package / "llm").glob("*.py"))]:
            out.write(source, str(Path(package.name) / source.relative_to(package)))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


class Tables:
    """Tables that :func:`settle` writes while this is entered; :meth:`drop` removes them and no others.

    Frames that read them must not be used afterwards.  What is settled outside of any stays until the application ends.
    """

    _entered: list[Tables] = []

    def __init__(self) -> None:
        self._paths: list[tuple[SparkSession, str]] = []

    def __enter__(self) -> Tables:
        Tables._entered.append(self)
        return self

    def __exit__(self, *_) -> None:
        Tables._entered.remove(self)

    @classmethod
    def current(cls) -> Tables:
        return cls._entered[-1] if cls._entered else _kept

    def add(self, spark: SparkSession, path: str) -> None:
        self._paths.append((spark, path))

    def hand_over(self) -> None:
        """Leave the tables to those entered now."""
        self.current()._paths.extend(self._paths)
        self._paths = []

    def drop(self) -> None:
        """Remove the tables; what the plans that wrote them left in shuffles goes with the driver's next collection, asked for here."""
        spark = self._paths[0][0] if self._paths else None
        while self._paths:
            spark, path = self._paths.pop()
            try:
                p = spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
            except Exception:  # the session has ended
                return
        if spark is not None and spark._jsc.sc() and not spark._jsc.sc().isStopped():
            spark._jvm.System.gc()


_kept = Tables()
atexit.register(_kept.drop)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/almanack/{uuid.uuid4().hex}-{name}"
    Tables.current().add(spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc32_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


#: Nodes of more edges than this are joined by broadcast, so many of them at most; tables of fewer edges than ``SMALL`` have none worth it.
HEAVY_EDGES, HEAVY_NODES, SMALL = 512, 1024, 1 << 11


def _with_low(edges: DataFrame, low: DataFrame, small: bool) -> DataFrame:
    """``edges`` (``u, v``) with the ``m`` of their ``u`` from ``low`` (``u, m, degree``).

    Rows of the nodes with the most edges stay where they are and get ``m`` by
    broadcast, so no task reads a hub; a node beyond ``HEAVY_NODES`` has fewer than that part of all edges.
    """
    heavy = [] if small else low.where(F.col("degree") > HEAVY_EDGES).orderBy(F.col("degree").desc(), "u").limit(HEAVY_NODES).select("u", "m").collect()
    low = low.select("u", "m")
    if not heavy:
        return edges.join(low, "u")
    hubs = F.broadcast(edges.sparkSession.createDataFrame(heavy, low.schema))
    return edges.join(hubs.select("u"), "u", "left_anti").join(low, "u").unionByName(edges.join(hubs, "u"))


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("degree"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list: ``node, component`` (smallest node) for every node on an edge.

    Alternating large-star and small-star rounds.  Every minimum is a partial
    aggregate, so a hub with a third of all edges costs one row per task in the
    shuffle, and its edges get the minimum by broadcast (:func:`_with_low`).
    Each round ends in a table in the shared folder; the one before it is removed.
    Self-loops and repeated edges are allowed; null ends are
    ignored; no edges give no rows.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a != b")
    held = Tables()
    with held:
        e = settle(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    small = e.count() < SMALL
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_low(both.where("v > u"), _lowest(both), small).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # now a node has an edge for each of its stars, of which there are few, and every v is the smaller
        near = large.join(_lowest(large).select("u", "m"), "u")
        stars = near.select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))).where("u != v").distinct()
        last, held = held, Tables()
        with held:
            e = settle(stars, "stars")
        last.drop()
        # done when all are stars: no parent is a child, no child has two parents
        parents = e.join(e.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")
        if parents.unionByName(e.groupBy("u").count().where("count > 1").select("u")).isEmpty():
            break
    held.hand_over()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
