"""Looking up, writing and removing small stored files, on any file system Spark reaches."""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _at(spark, path)
    return system.exists(folder)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds; whether there was one."""
    system, folder = _at(spark, path)
    return system.delete(folder, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, replacing an older one once it is complete."""
    system, target = _at(spark, path)
    folder, name = path.rpartition("/")[::2]
    _, part = _at(spark, f"{folder}/_{name}.part")
    out = system.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    system.delete(target, False)
    system.rename(part, target)
