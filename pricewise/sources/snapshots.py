"""Tables that are published as a whole: immutable snapshot folders and a manifest that is swapped by rename.

A writer fills a folder of its own and then renames a small new manifest over
the old one, in one step of the file system. Readers look the folder up once and
keep it, so they never see half a table, and a writer that dies before the swap
leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "_manifest.json"


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf).getUri()
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(root, conf), jvm


def _read_text(spark: SparkSession, path: str) -> str | None:
    fc, jvm = _fs(spark, path)
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not fc.util().exists(p):
        return None
    stream = fc.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fc, jvm = _fs(spark, path)
    flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.CreateOpts, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.CreateOpts.createParent()
    stream = fc.create(jvm.org.apache.hadoop.fs.Path(path), flags, options)
    try:
        stream.write(bytearray(text.encode()))
        stream.hsync()
    finally:
        stream.close()


def stage(df: DataFrame, path: str, order_by: list[str] | None = None) -> str:
    """Write the next snapshot of the table at ``path`` without publishing it; returns its name."""
    name = f"snapshot-{uuid.uuid4().hex}"
    (df.orderBy(*order_by) if order_by else df).write.parquet(f"{path.rstrip('/')}/{name}")
    return name


def swap(spark: SparkSession, path: str, name: str, **facts) -> None:
    """Make a staged snapshot the table's content: the new manifest takes the old one's place in one rename."""
    path = path.rstrip("/")
    new = f"{path}/_manifest-{uuid.uuid4().hex}.json"
    _write_text(spark, new, json.dumps({"snapshot": name, **facts}))
    fc, jvm = _fs(spark, path)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    fc.rename(jvm.org.apache.hadoop.fs.Path(new), jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}"), options)


def publish(df: DataFrame, path: str, order_by: list[str] | None = None, **facts) -> str:
    """Replace the table at ``path`` by ``df`` (which may have been read from it); returns the snapshot's name."""
    name = stage(df, path, order_by)
    swap(df.sparkSession, path, name, **facts)
    return name


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The published snapshot's name and facts; None if nothing was published."""
    text = _read_text(spark, f"{path.rstrip('/')}/{MANIFEST}")
    return None if text is None else json.loads(text)


def read_snapshot(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """The published content (or a named snapshot); later swaps do not change what it reads."""
    found = name or (manifest(spark, path) or {}).get("snapshot")
    if found is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{found}")


def remove_old(spark: SparkSession, path: str, keep: list[str]) -> list[str]:
    """Delete snapshots that are neither published nor in ``keep`` (those that readers still hold)."""
    fc, jvm = _fs(spark, path)
    live = {(manifest(spark, path) or {}).get("snapshot"), *keep}
    gone, found = [], fc.listStatus(jvm.org.apache.hadoop.fs.Path(path))
    while found.hasNext():
        p = found.next().getPath()
        if p.getName().startswith("snapshot-") and p.getName() not in live:
            fc.delete(p, True)
            gone.append(p.getName())
    return gone
