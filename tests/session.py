from pyspark.sql import SparkSession

from oreflow.sources.scratch import share_locally


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("oreflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    share_locally(spark)
    return spark
