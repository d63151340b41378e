"""Intermediate tables in the cluster's shared folder, and the row helpers of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelsight.session import work_dir


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage with a copy that every executor can read, so that a lost
    executor costs the tasks it ran and nothing before them.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Remove stored tables that no later step reads."""
    for t in tables:
        jvm = t.sparkSession._jvm
        conf = t.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            p = jvm.org.apache.hadoop.fs.Path(folder)
            p.getFileSystem(conf).delete(p, True)


def partitions_for(spark: SparkSession, amount: float, per_partition: float) -> int:
    """Partitions so that each holds about ``per_partition``, and no fewer than the session's default."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, int(amount // per_partition) + 1)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


MOST_BROADCAST = 1 << 20  # rows of two numbers (16 MB)


def small(table: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, to be broadcast if it has at most MOST_BROADCAST rows."""
    return F.broadcast(table) if table.count() <= MOST_BROADCAST else table


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: (node, component), component = smallest node.

    Every round takes the smallest label among a node's neighbours and then the
    label of that label. Messages are combined before they are shuffled, so a
    node with very many neighbours costs one row for each task. Each label is
    looked up once, however many nodes bear it, and handed back by broadcast
    while the labels that have moved are few.
    """
    both = store(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("m"))
        step = store(labels.join(near, labels.node == near.a).select("node", F.least("component", "m").alias("new"), F.col("component").alias("old")), "step")
        borne = step.select(F.col("new").alias("via")).distinct()
        far = step.filter("new < node").select(F.col("node").alias("of"), F.col("new").alias("root"))
        jumps = store(borne.join(far, borne.via == far.of).select("via", "root"), "jumps")
        new = store(step.join(small(jumps), step.new == jumps.via, "left").select("node", F.least("new", F.coalesce("root", "new")).alias("component"), "old"), "labels")
        moved = new.filter("component <> old").limit(1).count()
        drop(labels, step, jumps)
        labels = new.select("node", "component")
        if not moved:
            drop(both)
            return labels
