"""Layer writes and publishing to any Hadoop-compatible store.

A layer is a folder ``<base>/<layer>/<table>`` (``file:``, ``hdfs:``, ``s3a:``,
...; credentials come from the session's ``spark.hadoop.fs.*`` settings). Each
write goes to a build folder of its own, in parallel, through Spark's commit
protocol. As the last step a small pointer file is created, numbered one above
the pointer that was there when the write began and never overwriting one: of two
concurrent writers one fails, and no rename is involved. The highest readable number
is current. So the build before stays readable until the new one is complete, a
failed write changes nothing, and readers never see a half-written layer.

The pointer records the input build, the schema and the row counts of the write. The
last build before the current one is kept (a reader may hold it), and so are those
named by the base's snapshot; all others up to the own number go, among them what
killed writes left.

A *snapshot* of a base is one such numbered file that names a build of each layer:
readers of a snapshot see layers of one run, whatever is written meanwhile.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The layer names, in pipeline order.
LAYERS: list[str] = ["bronze", "silver", "gold"]

POINTERS = "_builds"
SNAPSHOTS = "_snapshots"


class ConcurrentWriteError(RuntimeError):
    """Another writer finished first; this write was undone."""


@dataclass(frozen=True)
class Build:
    """One complete write of a layer."""

    id: str
    path: str
    built_from: str | None = None
    previous: str | None = None
    number: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    schema: dict | None = None


def layer_path(base: str, layer: str, table: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{table}"


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(conf)


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    p, fs = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the files in a folder of numbered files, highest first."""
    return sorted((int(n[:-5]) for n in _names(spark, folder) if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def _numbered(folder: str, number: int) -> str:
    return f"{folder}/{number:08d}.json"


def _create(spark: SparkSession, path: str, content: dict) -> None:
    """Create a file that must not exist."""
    p, fs = _hadoop_path(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            raise ConcurrentWriteError(f"{path} was written by another run meanwhile") from None
        raise
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()


def _latest(spark: SparkSession, folder: str) -> tuple[int, dict] | None:
    """The highest file of a folder of numbered files that is complete (a writer may
    have been killed between creating and filling one)."""
    for number in _numbers(spark, folder):
        p, fs = _hadoop_path(spark, _numbered(folder, number))
        try:
            stream = fs.open(p)
        except Py4JJavaError:  # removed since it was listed: a newer one is there
            return _latest(spark, folder)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return number, json.loads(text)
        except ValueError:
            continue
    return None


def current_build(spark: SparkSession, path: str) -> Build | None:
    """The build the layer's latest pointer names, if there is one."""
    path = path.rstrip("/")
    latest = _latest(spark, f"{path}/{POINTERS}")
    return _as_build(path, *latest) if latest else None


def _as_build(path: str, number: int, found: dict) -> Build:
    return Build(
        found["build"], f"{path}/{found['build']}", found["built_from"], found["previous"], number, found["counts"], found["schema"]
    )


def data_path(spark: SparkSession, path: str) -> str:
    """Where the rows at ``path`` are: its current build, or the path itself
    (tables that this module did not write, or that a stream appends to)."""
    build = current_build(spark, path)
    return build.path if build else path


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    built_from: str | None = None,
    counts: Callable[[], dict[str, int]] | None = None,
    schema: StructType | None = None,
) -> Build:
    """Write ``df`` as a new build of the layer and make it the current one.

    ``df`` may read the layer it replaces. ``built_from`` names the input build,
    ``counts`` gives the row counts observed by the write once it has ended, and
    ``schema`` is what readers of the layer see (default: that of ``df``). Raises
    :class:`ConcurrentWriteError` when another writer finished since this one began.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    pointers = f"{path}/{POINTERS}"
    before = current_build(spark, path)
    number = max(_numbers(spark, pointers), default=0) + 1
    name = f"build-{number:08d}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    try:
        writer.parquet(f"{path}/{name}")
        content = {
            "build": name,
            "built_from": built_from,
            "previous": before.id if before else None,
            "counts": counts() if counts else {},
            "schema": (schema or df.schema).jsonValue(),
        }
        _create(spark, _numbered(pointers, number), content)
    except Exception:
        delete_path(spark, f"{path}/{name}")  # this write's own, unfinished folder
        raise
    _clear(spark, path, number, before)
    return _as_build(path, number, content)


def _clear(spark: SparkSession, path: str, number: int, before: Build | None) -> None:
    """Remove builds numbered up to ``number`` that nothing names any more. A writer
    that still works on one of them has lost its number and will fail."""
    latest = _latest(spark, f"{path}/{POINTERS}")
    kept = {latest[1]["build"]} if latest else set()
    kept |= {before.id} if before else set()
    snapshot = _latest(spark, f"{path.rsplit('/', 2)[0]}/{SNAPSHOTS}")
    kept |= {b["build"] for b in snapshot[1]["layers"].values() if b["path"] == path} if snapshot else set()
    for name in _names(spark, path):
        digits = name[6:14]
        if name.startswith("build-") and name not in kept and digits.isdigit() and int(digits) <= number:
            delete_path(spark, f"{path}/{name}")
    for old in _numbers(spark, f"{path}/{POINTERS}"):
        if old < (before.number if before else number):
            delete_path(spark, _numbered(f"{path}/{POINTERS}", old))


def layer_complete(spark: SparkSession, path: str) -> bool:
    """True when the layer has a current build, or ``path`` is a table with a
    finished write's ``_SUCCESS`` marker."""
    return current_build(spark, path) is not None or path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def take_snapshot(spark: SparkSession, base: str, builds: dict[str, Build]) -> int:
    """Name these builds as the layers of one run, in one step; returns the number."""
    base = base.rstrip("/")
    folder = f"{base}/{SNAPSHOTS}"
    number = max(_numbers(spark, folder), default=0) + 1
    layers = {
        layer: {"path": b.path.rsplit("/", 1)[0], "build": b.id, "schema": b.schema} for layer, b in builds.items()
    }
    _create(spark, _numbered(folder, number), {"layers": layers})
    for old in _numbers(spark, folder):
        if old < number - 1:
            delete_path(spark, _numbered(folder, old))
    return number


def snapshot_builds(spark: SparkSession, base: str) -> dict[str, Build]:
    """The builds that the base's snapshot names, by layer; empty without one."""
    latest = _latest(spark, f"{base.rstrip('/')}/{SNAPSHOTS}")
    found = latest[1]["layers"] if latest else {}
    return {layer: Build(b["build"], f"{b['path']}/{b['build']}", schema=b["schema"]) for layer, b in found.items()}


def publish_layers(layers: dict[str, DataFrame], base: str, tables: dict[str, str] | None = None) -> dict[str, str]:
    """Write each named layer to ``<base>/<layer>/<table>``, then name all of them in
    one snapshot of the base; returns the paths.

    Unlike an upload loop, a missing or failing layer raises — nothing is
    skipped in silence, and the snapshot stays as it was. A target that holds a table
    this module did not write is refused, so publishing never mixes with it.
    """
    tables = tables or {}
    paths: dict[str, str] = {}
    builds: dict[str, Build] = {}
    for layer, df in layers.items():
        path = layer_path(base, layer, tables.get(layer, "orders"))
        refuse_foreign(df.sparkSession, path)
        builds[layer] = write_layer(df, path)
        paths[layer] = path
    if layers:
        take_snapshot(next(iter(layers.values())).sparkSession, base, builds)
    return paths


def refuse_foreign(spark: SparkSession, path: str) -> None:
    """Raise when ``path`` is a table that a stream or another writer owns."""
    if path_exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is kept by an incremental run; use another base for batch layers")
    if path_exists(spark, f"{path}/_SUCCESS") and current_build(spark, path) is None:
        raise ValueError(f"{path} holds a table that is no layer build; use another base")
