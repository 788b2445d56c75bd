"""Publishing a run in two steps: stage all tables under the run's id, look at what was staged, then switch one pointer.

Under a root folder, `runs/<id>/<table>` holds the tables of a run and `pointers/<number>` names one run per file; the file with
the highest number names the run that readers see. A pointer is written beside its place and renamed into it, and a name that
exists is never replaced. So readers see the old run or the new one, whatever happens in between, and of two writers that
switch at once one is told so.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfline.operators.quality import QualityError, require_none
from shelfline.session import files_of
from shelfline.sources import schemas
from shelfline.sources.sinks import conform

_NUMBER = re.compile(r"\d{12}")


def stage(
    frames: Mapping[str, DataFrame], root: str, run_id: str, targets: Mapping[str, T.StructType] = schemas.SERVING,
    served: Mapping[str, str] = schemas.SERVED,
) -> dict[str, DataFrame]:
    """Writes every target for which there is a frame, with the target's columns, and returns scans of what was written. A frame
    that fills several targets with the same columns is computed once; the others are written from the first one's scan."""
    staged, first = {}, {}
    for target, schema in targets.items():
        if served[target] in frames:
            path, rows = f"{root}/runs/{run_id}/{target}", frames[served[target]]
            known = first.setdefault((served[target], schema.json()), target)
            (staged[known] if known in staged else conform(rows, schema)).write.mode("errorifexists").parquet(path)
            staged[target] = rows.sparkSession.read.schema(schema).parquet(path)
    return staged


def _pointers(spark: SparkSession, root: str) -> list[str]:
    path, files = files_of(spark, f"{root}/pointers")
    if not files.exists(path):
        return []
    return sorted(name for name in (s.getPath().getName() for s in files.listStatus(path)) if _NUMBER.fullmatch(name))


def _named(spark: SparkSession, root: str, pointer: str) -> str:
    path, files = files_of(spark, f"{root}/pointers/{pointer}")
    stream = files.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def current(spark: SparkSession, root: str) -> str | None:
    """The run that readers see; None before the first."""
    found = _pointers(spark, root)
    return _named(spark, root, found[-1]) if found else None


def switch(spark: SparkSession, root: str, run_id: str) -> None:
    """Lets readers see a staged run. Stops if another writer has switched since the pointers were listed."""
    found = _pointers(spark, root)
    number = int(found[-1]) + 1 if found else 1
    place, files = files_of(spark, f"{root}/pointers/{number:012d}")
    beside, _ = files_of(spark, f"{root}/pointers/.{uuid.uuid4().hex}")
    stream = files.create(beside, False)
    stream.write(bytearray(run_id.encode()))
    stream.close()
    if files.exists(place) or not files.rename(beside, place):
        files.delete(beside, False)
        raise QualityError(f"another run was published as number {number}")


def publish(
    frames: Mapping[str, DataFrame], root: str, gate: Callable[[dict[str, DataFrame]], DataFrame], run_id: str | None = None,
    targets: Mapping[str, T.StructType] = schemas.SERVING, served: Mapping[str, str] = schemas.SERVED,
) -> str:
    """Stages, lets `gate` count failures per test on the staged tables, and switches if there are none. With failures, or if
    the run ends before the switch, readers go on with the run before."""
    run_id = run_id or uuid.uuid4().hex
    spark = next(iter(frames.values())).sparkSession
    staged = stage(frames, root, run_id, targets, served)
    require_none(gate(staged).filter("failures > 0"), f"the gate of run {run_id}")
    switch(spark, root, run_id)
    return run_id


def read(spark: SparkSession, root: str, target: str, targets: Mapping[str, T.StructType] = schemas.SERVING) -> DataFrame:
    """A table of the published run."""
    run_id = current(spark, root)
    if run_id is None:
        raise QualityError(f"nothing is published under {root}")
    return spark.read.schema(targets[target]).parquet(f"{root}/runs/{run_id}/{target}")


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes the tables of runs that are neither among the last `keep` published ones nor newer than them (these may still be
    staged), and names them."""
    pointers = _pointers(spark, root)
    published = [_named(spark, root, p) for p in pointers]
    gone = [r for r in dict.fromkeys(published[:-keep]) if r not in published[-keep:]]
    for run_id in gone:
        path, files = files_of(spark, f"{root}/runs/{run_id}")
        files.delete(path, True)
    return gone
