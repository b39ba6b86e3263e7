"""Tables that are written in runs and become visible by a commit record.

A run writes to a folder of its own. When all of its files are there, one small record
below `_commits` names the folders that make up the table from then on. Readers
follow the last readable record, so a job that is killed midway leaves the table as it was, and
a rebuilt table has nothing of the old one. A run may replace the whole table or
only some values of some columns (some models); the rest stays in the folders of older runs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Another run has committed since this one looked."""


class NoTable(FileNotFoundError):
    """Nothing is stored under a path."""


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    where, fs = _fs(spark, path)
    return fs.exists(where)


def records(spark: SparkSession, path: str) -> list[dict]:
    """Commit records in order; one that can't be read (its writer was killed) is left out."""
    where, fs = _fs(spark, f"{path}/{COMMITS}")
    if not fs.exists(where):
        return []
    out = []
    for status in fs.listStatus(where):
        name = status.getPath().getName()
        if not name.endswith(".json"):
            continue
        stream = fs.open(status.getPath())
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            out.append({"number": int(name.split(".")[0]), "parts": json.loads(text)["parts"]})
        except (ValueError, KeyError):
            continue
    return sorted(out, key=lambda r: r["number"])


def new_run(path: str) -> str:
    """The folder of a new run; nothing reads it before it is committed."""
    return f"{path}/run-{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, folder: str, schema: T.StructType, keys: Sequence[str] = (),
           values: Sequence[Sequence[str]] = ()) -> int:
    """Make a run visible: as the whole table, or, with `keys`, for the given values of these columns.

    The record keeps the schema, so a run without rows can be read and partition values keep their types.
    It is created under the next number; if another run took the number first, this one fails and
    the table stays as that run left it.
    """
    done = records(spark, path)
    last = done[-1] if done else {"number": 0, "parts": []}
    taken = sorted(list(v) for v in values)
    parts = []
    for part in last["parts"] if keys else ():
        if part["values"] is None:
            without = [v for v in part["without"] if v not in taken] + taken
            parts.append({**part, "keys": list(keys), "without": sorted(without)})
        elif left := [v for v in part["values"] if v not in taken]:
            parts.append({**part, "values": left})
    parts.append({"folder": folder.rsplit("/", 1)[1], "schema": schema.jsonValue(), "keys": list(keys), "values": taken if keys else None, "without": []})
    number = last["number"] + 1
    where, fs = _fs(spark, f"{path}/{COMMITS}/{number:08d}.json")
    try:
        stream = fs.create(where, False)
    except Py4JJavaError as error:
        raise CommitConflict(f"{path}: run {number} was committed by another writer") from error
    stream.write(bytearray(json.dumps({"parts": parts}).encode()))
    stream.close()
    return number


def _any_of(keys: Sequence[str], values: Sequence[Sequence[str]]) -> Column:
    """Whether the keys have one of the values; on partition columns Spark prunes by it."""
    if len(keys) == 1:
        return F.col(keys[0]).isin(*[v[0] for v in values])
    each = [reduce(lambda a, b: a & b, [F.col(k) == x for k, x in zip(keys, v)]) for v in values]
    return reduce(lambda a, b: a | b, each, F.lit(False))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as the last commit left it; without any commit, plain Parquet under the path."""
    done = records(spark, path)
    if not done:
        where, fs = _fs(spark, path)
        if not fs.exists(where):
            raise NoTable(path)
        if any(s.getPath().getName().startswith("run-") for s in fs.listStatus(where)):
            raise NoTable(f"{path}: no run was committed")
        return spark.read.parquet(path)
    frames = []
    for part in done[-1]["parts"]:
        df = spark.read.schema(T.StructType.fromJson(part["schema"])).parquet(f"{path}/{part['folder']}")
        if part["values"] is not None:
            df = df.filter(_any_of(part["keys"], part["values"]))
        elif part["without"]:
            df = df.filter(~F.coalesce(_any_of(part["keys"], part["without"]), F.lit(False)))
        frames.append(df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _fs(spark, path)
    return bool(records(spark, path)) or fs.exists(where) and not any(s.getPath().getName().startswith("run-") for s in fs.listStatus(where))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove folders and records that none of the last `keep` commits uses; readers of those go on undisturbed.

    Folders of runs that were never committed stay: they may belong to a writer at work.
    """
    done = records(spark, path)
    old, new = done[:-keep], done[-keep:]
    used = {p["folder"] for r in new for p in r["parts"]}
    gone = sorted({p["folder"] for r in old for p in r["parts"]} - used)
    for name in [*gone, *[f"{COMMITS}/{r['number']:08d}.json" for r in old]]:
        where, fs = _fs(spark, f"{path}/{name}")
        fs.delete(where, True)
    return gone
