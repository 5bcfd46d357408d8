from pyspark.sql import functions as F

from millrace.operators.tables import written


def test_shuffle_files_go_with_the_write(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    blocks = lambda: {x for x in manager.getAllBlocks().mkString(" ").split() if x.startswith("shuffle_")}
    before, setting = blocks(), spark.conf.get(name)
    found = written(spark.range(100_000).groupBy((F.col("id") * 7).alias("k")).agg(F.count("*").alias("n")), "counts")
    assert not blocks() - before
    assert found.count() == 100_000 and spark.conf.get(name) == setting
