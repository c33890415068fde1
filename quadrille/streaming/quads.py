"""Statements that arrive as files of N-Quads: an incremental build, and a standing pattern over the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quadrille.operators.relation import Relation
from quadrille.plans.compiler import DEFAULT
from quadrille.plans.parser import Triple
from quadrille.sources.nquads import parse_lines
from quadrille.sources.quads import QuadSource
from quadrille.sources.store import KNOWN_PREDICATES, read_meta, write_meta


def read_stream(spark: SparkSession, folder: str, files_per_batch: int = 100, strict: bool = True) -> DataFrame:
    """(s, p, o, g) of new files. A line that is no statement fails the stream; if not strict, it comes as a row of NULLs with the line in `bad`."""
    parsed = parse_lines(spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder))
    if not strict:
        return parsed
    fail = F.raise_error(F.concat(F.lit("not a statement: "), F.col("bad")))
    return parsed.withColumn("s", F.when(F.col("bad").isNotNull(), fail).otherwise(F.col("s"))).drop("bad")


def append_to_store(stream: DataFrame, path: str, checkpoint: str, rejected: str | None = None) -> StreamingQuery:
    """Adds statements that the store does not have, batch by batch; a batch that is run again adds nothing.

    A store that is not there yet is begun. Its facts (size, counts, whether a triple is in several graphs) go with each
    batch; what makes a reader careful is written before the statements, so a batch that is cut short leaves no wrong
    answer. Lines that are no statements, which a stream that is not strict has, are appended to the text files of
    `rejected`, batch by batch; without that folder they fail the stream. Only the spelled layout grows."""
    spark = stream.sparkSession
    if "bad" in stream.columns and rejected is None:
        raise ValueError("a stream that is not strict needs a folder for rejected lines")

    def exists(name: str) -> bool:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def each(batch: DataFrame, number: int) -> None:
        if "bad" in batch.columns:
            batch.where("bad is not null").select(F.col("bad").alias("value")).write.mode("overwrite").text(f"{rejected}/batch={number}")
            batch = batch.where("bad is null")
        batch = batch.select("s", "p", "o", "g").distinct()
        meta = read_meta(spark, path) if exists(f"{path}/_meta") else {"layout": "spelled", "quads": 0, "repeats": exists(f"{path}/quads"), "by_object": False, "counts": {}}
        if meta["layout"] != "spelled":
            raise ValueError(f"a store of the {meta['layout']} layout is not appended to; build it anew")
        predicates = [r["p"] for r in batch.select("p").distinct().limit(1001).collect()]
        fresh = batch
        if exists(f"{path}/quads"):
            have = spark.read.parquet(f"{path}/quads")
            if len(predicates) <= 1000:  # the store is laid out by predicate, so most files are left out
                have = have.where(F.col("p").isin(predicates))
            fresh = batch.join(have, ["s", "p", "o", "g"], "left_anti").persist()
            twice = have.select("s", "p", "o").join(fresh, ["s", "p", "o"], "left_semi").limit(1).count() > 0
        else:
            fresh, twice = fresh.persist(), False
        try:
            counts = {r["p"]: r["n"] for r in fresh.groupBy("p").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(KNOWN_PREDICATES).collect()}
            twice = twice or fresh.groupBy("s", "p", "o").count().where("count > 1").limit(1).count() > 0
            if twice and not meta["repeats"] or not exists(f"{path}/_meta"):
                meta["repeats"] = meta["repeats"] or twice
                write_meta(spark, path, meta)
            fresh.sortWithinPartitions("p", "s").write.mode("append").parquet(f"{path}/quads")
            if meta["by_object"]:
                copy = spark.read.parquet(f"{path}/by_object").where(F.col("p").isin(predicates) if len(predicates) <= 1000 else F.lit(True))
                batch.join(copy, ["s", "p", "o", "g"], "left_anti").sortWithinPartitions("p", "o").write.mode("append").parquet(f"{path}/by_object")
            every = {p: meta["counts"].get(p, 0) + counts.get(p, 0) for p in {*meta["counts"], *counts}}
            meta["counts"] = dict(sorted(every.items(), key=lambda x: -x[1])[:KNOWN_PREDICATES])
            meta["quads"] = spark.read.parquet(f"{path}/quads").count()
            write_meta(spark, path, meta)
        finally:
            fresh.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def match(stream: DataFrame, triple: Triple) -> Relation:
    """A pattern over each batch's statements; joins with static relations go on as with any other relation."""
    return QuadSource(stream, union=True, repeats=False).match(stream.sparkSession, [triple], DEFAULT)
