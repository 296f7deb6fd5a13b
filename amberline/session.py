"""Session settings the jobs were tuned with.  None is needed for right results."""

from __future__ import annotations


def recommended(local_cores: int | None = None) -> dict[str, str]:
    """Settings for a session.

    Adaptive execution splits skewed join partitions and picks the number of
    reducers from a generous start; ``hugeMethodLimit`` drops whole-stage code
    that the JVM would refuse to compile in favour of code split into small
    methods.  On a cluster also set ``spark.checkpoint.dir`` to a shared folder.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.ui.showConsoleProgress": "false",
    }
    if local_cores:
        settings |= {"spark.sql.shuffle.partitions": str(local_cores), "spark.ui.enabled": "false"}
    else:
        settings |= {"spark.sql.shuffle.partitions": "4000",
                     "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m"}
    return settings
