"""Session settings the library depends on, and the shared working folder."""

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SHARED_DIR = "spark.checkpoint.dir"

#: What a task reads at most, as rows take far more memory than the bytes they are read from: account-days
#: and names some 30 times their shuffled bytes, sorted messages some 15 times those of their file.
TASK_READS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.files.maxPartitionBytes": "32MB",
}


def _bytes(size: str) -> int:
    """A size as Spark writes it, such as 64MB, 8m or 67108864b."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on, bound what a task reads; leave other sizing to the cluster.

    Calendar columns are UTC. Adaptive execution sizes shuffles at run time and
    splits the partitions of a hot sender in the scoring join; it hashes instead
    of sorting where every partition of one side is found to be small. Smaller
    bounds that the cluster sets for a task's input stay.
    """
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    }.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, most in TASK_READS.items():
        if _bytes(spark.conf.get(key)) > _bytes(most):
            spark.conf.set(key, most)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, for tables a job stages.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session may go without, since there all executors share one machine.
    """
    base = spark.conf.get(SHARED_DIR, None) or spark.sparkContext.getConf().get(SHARED_DIR)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SHARED_DIR} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="paytrail-")
        spark.conf.set(SHARED_DIR, base)
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
