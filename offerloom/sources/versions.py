"""Tables in versions: a reader sees one whole version, whatever a writer does, or loses, meanwhile.

Rows are written to a folder of their own first. Then a small file that names the folders of
the new version appears at once under the next number, by a rename that doesn't replace a file.
The shared store's rename must be atomic (HDFS and local folders; of object stores those that say so).
A write that is lost before leaves a folder that nothing names, and ``clean`` deletes it.

What a version reads stays while the next one is written, so a table may be replaced by rows that are read from it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace as changed

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Folders of one level that an append merges into one of the next: n appends write each row about log(n) times.
MERGED = 16


class Overtaken(RuntimeError):
    """Another writer was faster; the version that this one began from isn't the current one any more."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    form: str = "parquet"
    folders: tuple[tuple[str, int], ...] = ()  # (name, level)
    header: tuple[str, ...] = ()
    batches: dict[str, int] = field(default_factory=dict)


def _store(spark: SparkSession, path: str):
    """(Path class, the path's own file system)"""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path
    return at, at(path).getFileSystem(context._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, folder: str) -> list:
    at, store = _store(spark, folder)
    return list(store.listStatus(at(folder))) if store.exists(at(folder)) else []


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions that are kept, ascending."""
    names = (s.getPath().getName() for s in _listed(spark, f"{path}/versions"))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version by its number, or the current one; number 0 and no folders where nothing was ever written."""
    known = numbers(spark, path)
    if number is None and not known:
        return Version()
    number = known[-1] if number is None else number
    said = json.loads(spark.read.text(f"{path}/versions/{number:012d}.json", wholetext=True).first()[0])
    return Version(number, said["form"], tuple((n, level) for n, level in said["folders"]), tuple(said["header"]), said["batches"])


def read(spark: SparkSession, path: str, schema: str, number: int | None = None) -> DataFrame:
    """Rows of the current version, or of the one named; none where nothing was written."""
    found = version(spark, path, number)
    if not found.folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(found.form).load([f"{path}/data/{n}" for n, _ in found.folders])


def _publish(spark: SparkSession, path: str, new: Version) -> Version:
    """Makes ``new`` the version after its number, unless there is one."""
    jvm, (at, store) = spark.sparkContext._jvm, _store(spark, path)
    aside, final = at(f"{path}/versions/.{uuid.uuid4().hex}"), at(f"{path}/versions/{new.number + 1:012d}.json")
    out = store.create(aside, False)
    out.write(bytearray(json.dumps({"form": new.form, "folders": new.folders, "header": new.header, "batches": new.batches}), "utf-8"))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri() if final.isAbsolute() and final.toUri().getScheme() else store.getUri(), store.getConf())
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        files.rename(aside, final, spark.sparkContext._gateway.new_array(kinds, 0))
    except Py4JJavaError as failed:
        store.delete(aside, False)
        if "FileAlreadyExistsException" in failed.java_exception.getClass().getName():
            raise Overtaken(f"version {new.number + 1} of {path} was written meanwhile") from failed
        raise
    return changed(new, number=new.number + 1)


def _written(rows: DataFrame, path: str, form: str) -> str:
    name = uuid.uuid4().hex
    rows.write.format(form).save(f"{path}/data/{name}")
    return name


def replace(rows: DataFrame, path: str, form: str = "parquet", header: list[str] | None = None, unless_empty: bool = False) -> bool:
    """Makes ``rows`` the table. Says whether it did.

    The header of the version before stays if none is given. With ``unless_empty`` a
    table without rows replaces nothing; what was written is looked at, so rows
    are computed once. Raises ``Overtaken`` if another version appeared after this one began.
    """
    spark = rows.sparkSession
    before = version(spark, path)
    name = _written(rows, path, form)
    if unless_empty and spark.read.schema(rows.schema).format(form).load(f"{path}/data/{name}").isEmpty():
        _drop(spark, path, name)
        return False
    _publish(spark, path, changed(before, form=form, folders=((name, 0),), header=before.header if header is None else tuple(header), batches={}))
    return True


def append(rows: DataFrame, path: str, writer: str, batch: int, tries: int = 20) -> bool:
    """Adds a writer's batch once, however often it comes. Says whether it did.

    Batches of a writer come by ascending numbers, and a number that isn't above the last one was added
    before. Several writers may append at once: the slower one tries again from the new version, without writing
    its rows again. ``MERGED`` folders of a level become one, as Parquet, so a version names few folders.
    """
    spark, name = rows.sparkSession, None
    for _ in range(tries):
        before = version(spark, path)
        if before.batches.get(writer, -1) >= batch:
            if name:
                _drop(spark, path, name)
            return False
        name = name or _written(rows, path, "parquet")
        folders, made, level = [*before.folders, (name, 0)], [], 0
        while sum(at == level for _, at in folders) >= MERGED:
            merged = spark.read.schema(rows.schema).parquet(*(f"{path}/data/{n}" for n, at in folders if at == level))
            made.append(_written(merged, path, "parquet"))
            folders, level = [f for f in folders if f[1] != level] + [(made[-1], level + 1)], level + 1
        try:
            _publish(spark, path, changed(before, form="parquet", folders=tuple(folders), batches={**before.batches, writer: batch}))
            return True
        except Overtaken:
            for n in made:
                _drop(spark, path, n)
    raise Overtaken(f"{tries} times another writer of {path} was faster")


def appender(path: str, writer: str) -> Callable[[DataFrame, int], None]:
    """For ``writeStream.foreachBatch``: a batch that a restarted stream sends again is added once."""
    return lambda rows, batch: append(rows, path, writer, batch) and None


def _drop(spark: SparkSession, path: str, name: str) -> None:
    at, store = _store(spark, path)
    store.delete(at(f"{path}/data/{name}"), True)


def clean(spark: SparkSession, path: str, keep: int = 2, grace: float = 86_400.0) -> int:
    """Deletes all but the last ``keep`` versions, and folders that none of these names and that are older than ``grace`` seconds.

    Younger ones may be a writer's that isn't done. Says how many folders went. At least the current version stays.
    """
    at, store = _store(spark, path)
    known = numbers(spark, path)
    kept = known[-max(keep, 1) :]
    used = {n for k in kept for n, _ in version(spark, path, k).folders}
    for k in known[: -len(kept)] if kept else []:
        store.delete(at(f"{path}/versions/{k:012d}.json"), False)
    old = [s for s in _listed(spark, f"{path}/data") if s.getPath().getName() not in used and s.getModificationTime() <= (time.time() - grace) * 1000]
    for s in old:
        store.delete(s.getPath(), True)
    return len(old)
