"""One panel per session and data directory, rebuilt when its files change."""

from __future__ import annotations

from pyspark.sql import SparkSession

from weekgrid.sources.panel import Panel

SOURCES = ["lineitem", "orders", "customer", "nation"]
_panels: dict[tuple, Panel] = {}


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, length and change time of every file of the sources, at any depth."""
    conf = spark._jsc.hadoopConfiguration()
    found = []
    for name in SOURCES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            status = files.next()
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def panel(spark: SparkSession, sf_dir: str) -> Panel:
    """The panel whose weekly amounts and gold table are written once, as the
    layers of a lakehouse are, and read by every later job."""
    key = (spark.sparkContext.applicationId, sf_dir, _fingerprint(spark, sf_dir))
    if key not in _panels:
        _panels[key] = Panel(spark, sf_dir)
    return _panels[key]
