"""Merge of landed batches, month by month, behind a manifest.

Streams land batches as ``<table>/batch_id=k/month=m``. A merge takes the batches since the last one, unites those of
each month with what the month held, keeps the last write of each sort key, and writes the month anew beside the old.
Then a manifest with a higher version names the folders of all months and the first batch that is not merged. A reader
takes one manifest, so it sees the state before a merge or after it, never both. Months that no new batch touches are
neither read nor written. A sort key decides the month, so that copies of a row meet in one month.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import landing

_ROW = "month string, path string, upto long"


@dataclass(frozen=True)
class Manifest:
    """Folders of merged months by month, and the first batch that is not in them."""

    version: int
    upto: int
    months: dict[str, str]


def _fs(spark: SparkSession, path: str):
    """The file system of a path, whichever it is, and the path as it names it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory())


def _numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    return sorted(int(n.removeprefix(prefix)) for n in _folders(spark, path) if n.startswith(prefix))


def _complete(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, f"{path}/_SUCCESS")
    return fs.exists(at)


def read_manifest(spark: SparkSession, root: str, table: str) -> Manifest:
    """The newest one whose writing has ended; before the first merge an empty one."""
    for version in reversed(_numbered(spark, f"{root}/{table}_manifest", "version=")):
        path = f"{root}/{table}_manifest/version={version}"
        if _complete(spark, path):
            rows = spark.read.schema(_ROW).json(path).collect()
            return Manifest(version, max(r.upto for r in rows), {r.month: r.path for r in rows if r.month is not None})
    return Manifest(-1, 0, {})


def _write_manifest(spark: SparkSession, root: str, table: str, manifest: Manifest) -> None:
    rows = [(None, None, manifest.upto), *((m, p, manifest.upto) for m, p in sorted(manifest.months.items()))]
    path = f"{root}/{table}_manifest/version={manifest.version}"
    spark.createDataFrame(rows, _ROW).coalesce(1).write.mode("errorifexists").json(path)


def _fresh(spark: SparkSession, root: str, table: str, upto: int, months: set[str] | None = None) -> list[str]:
    """Month folders of the batches from one on."""
    found = []
    for batch in _numbered(spark, f"{root}/{table}", "batch_id="):
        path = f"{root}/{table}/batch_id={batch}"
        if batch >= upto and _complete(spark, path):
            found += [f"{path}/{m}" for m in _folders(spark, path) if m.startswith("month=") and (months is None or m.removeprefix("month=") in months)]
    return found


def _read(spark: SparkSession, merged: list[str], fresh: list[str]) -> DataFrame | None:
    parts = [spark.read.parquet(*paths) for paths in (merged, fresh) if paths]
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def read_landed(spark: SparkSession, root: str, table: str, months: set[str] | None = None, manifest: Manifest | None = None) -> DataFrame | None:
    """The rows of a landed table, the last write of each sort key; of some months only, if named.

    Merged months without a fresh batch have one row for each key already and are not sorted again.
    """
    known = manifest or read_manifest(spark, root, table)
    fresh = _fresh(spark, root, table, known.upto, months)
    touched = {p.rsplit("month=", 1)[1] for p in fresh}
    wanted = {m: p for m, p in known.months.items() if months is None or m in months}
    settled = [p for m, p in wanted.items() if m not in touched]
    open_ = _read(spark, [p for m, p in wanted.items() if m in touched], fresh)
    if open_ is not None:
        open_ = landing.dedup_replacing(open_, landing.SORT_KEYS[table])
    done = _read(spark, settled, [])
    if done is None or open_ is None:
        return done if open_ is None else open_
    return done.unionByName(open_, allowMissingColumns=True)


def merge(spark: SparkSession, root: str, table: str, keep_from: str | None = None) -> Manifest:
    """Merges the batches since the last merge and gives the new manifest; months before ``keep_from`` (yyyyMM) fall out.

    One merge of a table runs at a time: a second one fails when it writes the same version.
    """
    known = read_manifest(spark, root, table)
    batches = [b for b in _numbered(spark, f"{root}/{table}", "batch_id=") if b >= known.upto and _complete(spark, f"{root}/{table}/batch_id={b}")]
    upto = batches[-1] + 1 if batches else known.upto
    fresh = [p for p in _fresh(spark, root, table, known.upto) if int(p.split("/batch_id=")[1].split("/")[0]) < upto]
    kept = {m: p for m, p in known.months.items() if keep_from is None or m >= keep_from}
    fresh = [p for p in fresh if keep_from is None or p.rsplit("month=", 1)[1] >= keep_from]
    touched = sorted({p.rsplit("month=", 1)[1] for p in fresh})
    if touched:
        folder = f"{root}/{table}_merged/{uuid.uuid4().hex}"
        # The folder's name tells the month; the column is taken from it again when all months are written at once.
        parts = []
        for month in touched:
            rows = _read(spark, [kept[month]] if month in kept else [], [p for p in fresh if p.endswith(f"month={month}")])
            parts.append(rows.withColumn("month", F.lit(month)))
        both = parts[0]
        for part in parts[1:]:
            both = both.unionByName(part, allowMissingColumns=True)
        keys = landing.SORT_KEYS[table]
        last = landing.dedup_replacing(both, ["month", *keys])
        last.repartition("month", keys[0]).sortWithinPartitions("month", *keys).write.partitionBy("month").parquet(folder)
        kept |= {m: f"{folder}/month={m}" for m in touched}
    new = Manifest(known.version + 1, upto, kept)
    _write_manifest(spark, root, table, new)
    return new


def vacuum(spark: SparkSession, root: str, table: str, keep: int = 2) -> list[str]:
    """Deletes what the newest ``keep`` manifests do not name: old months, merged batches, older manifests."""
    versions = [v for v in _numbered(spark, f"{root}/{table}_manifest", "version=") if _complete(spark, f"{root}/{table}_manifest/version={v}")]
    old, live = versions[:-keep], versions[-keep:]
    if not live:
        return []
    named, uptos = set(), []
    for version in live:
        rows = spark.read.schema(_ROW).json(f"{root}/{table}_manifest/version={version}").collect()
        named |= {r.path for r in rows if r.path is not None}
        uptos.append(max(r.upto for r in rows))
    gone = [f"{root}/{table}_manifest/version={v}" for v in old]
    gone += [f"{root}/{table}/batch_id={b}" for b in _numbered(spark, f"{root}/{table}", "batch_id=") if b < min(uptos)]
    for run in _folders(spark, f"{root}/{table}_merged"):
        path = f"{root}/{table}_merged/{run}"
        if _complete(spark, path):
            gone += [f"{path}/{m}" for m in _folders(spark, path) if f"{path}/{m}" not in named]
    for path in gone:
        fs, at = _fs(spark, path)
        fs.delete(at, True)
    return gone
