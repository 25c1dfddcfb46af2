"""Replacing many days of a table as one step that a crash cannot leave half done.

New partitions are first written beside the table. A plan then lists what is to happen to each day:
taking in its staged partition, or going, since the day has no rows any more. Once the plan's file
stands, the change is decided; moving partitions is a matter of names, and whoever touches the table
next finishes it. Without a plan nothing has happened, and what was staged is thrown away. Days whose
rows are what they were are not touched.

One writer at a time is assumed, as for any table of files. Folders whose names begin with an
underscore are not part of the table to Spark.
"""

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rulecast.sources.readers import on_days
from rulecast.sources.schemas import PARTITION

WORK, DIGESTS = "_publish", "_digests.json"
#: Parts of a day, so that a heavy one is not one task.
PARTS = 8
#: Rows that come dealt out by day and part say so by a column of this name.
PART = "_part"


@dataclass
class Published:
    """What happened to the days of a range."""

    written: list[dt.date] = field(default_factory=list)
    removed: list[dt.date] = field(default_factory=list)
    unchanged: list[dt.date] = field(default_factory=list)


@dataclass
class Change(Published):
    """What is to happen to the days of a range, and the digests of those that have rows."""

    digests: dict[dt.date, list] = field(default_factory=dict)


class Files:
    """The few file operations needed, on the file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, name: str) -> list[str]:
        """Names in a folder, hidden ones left out; of a missing folder none."""
        if not self.exists(name):
            return []
        found = (status.getPath().getName() for status in self.fs.listStatus(self.path(name)))
        return sorted(n for n in found if not n.startswith(("_", ".")))

    def move(self, name: str, to: str) -> None:
        self.fs.mkdirs(self.path(to).getParent())
        if not self.fs.rename(self.path(name), self.path(to)):
            raise OSError(f"cannot move {name} to {to} in {self.root}")

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file appears with all of its text or not at all."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        stream = self.fs.create(self.path(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.remove(name)
        self.move(draft, name)


def day_folder(day: dt.date) -> str:
    return f"year={day.year}/month={day.month}/day={day.day}"


def table_exists(spark: SparkSession, path: str) -> bool:
    return Files(spark, path).exists("")


def _digests(rows: DataFrame) -> dict[dt.date, list]:
    """Per day the number of rows and two sums of their hashes, whatever their order."""
    columns = [c for c in rows.columns if c not in PARTITION]
    one = F.xxhash64(*columns)
    other = F.xxhash64(F.lit("second"), *columns)
    # The second sum does not fit a long; its halves do, and cost less than a decimal.
    high, low = F.shiftright(other, 32), other.bitwiseAND(F.lit(0xFFFFFFFF))
    sums = [F.sum(high).alias("high"), F.sum(low).alias("low")]
    days = rows.groupBy(*PARTITION).agg(F.count("*").alias("n"), F.bit_xor(one).alias("x"), *sums)
    return {dt.date(r.year, r.month, r.day): [r.n, r.x, str((r.high << 32) + r.low)] for r in days.toLocalIterator()}  # a row per day


def staging(path: str, run: str) -> str:
    """Where a run puts the folders that are to replace those of the table at ``path``."""
    return f"{path}/{WORK}/{run}/data"


def decide(files: Files, run: str, taken: dict[str, list | None], gone: list[str] = ()) -> None:
    """Let the staged folders ``taken``, with their digests if known, replace the table's, and ``gone`` go."""
    plan = {f: {"before": files.names(f), "files": files.names(f"{WORK}/{run}/data/{f}"), "digest": d} for f, d in taken.items()}
    plan |= {f: {"before": files.names(f), "files": None} for f in gone}
    files.write(f"{WORK}/{run}/plan.json", json.dumps(plan))
    _apply(files, run, plan)


def _apply(files: Files, run: str, plan: dict) -> None:
    """Carry out a plan, wholly or what is left of it.

    A folder that someone has written since the plan was made has files that the plan does not know:
    that is newer and stays.
    """
    known = json.loads(files.read(DIGESTS)) if files.exists(DIGESTS) else {}
    for folder, step in plan.items():
        live = files.names(folder)
        if step["files"] is not None and live == step["files"]:
            known[folder] = {"files": live, "digest": step["digest"]}
        elif set(live) <= set(step["before"]):
            files.remove(folder)
            known.pop(folder, None)
            if step["files"] is not None:
                files.move(f"{WORK}/{run}/data/{folder}", folder)
                known[folder] = {"files": step["files"], "digest": step["digest"]}
    files.write(DIGESTS, json.dumps(known))
    files.remove(f"{WORK}/{run}")


def finish(spark: SparkSession, path: str) -> None:
    """Carry out plans that a crash has left, and remove what was staged without one."""
    files = Files(spark, path)
    for run in files.names(WORK):
        if files.exists(f"{WORK}/{run}/plan.json"):
            _apply(files, run, json.loads(files.read(f"{WORK}/{run}/plan.json")))
        else:
            files.remove(f"{WORK}/{run}")


def replace_days(df: DataFrame, path: str, first: dt.date, last: dt.date) -> Published:
    """Let the days ``first`` to ``last``, both included, hold the rows of ``df`` of these days.

    Days with other rows than before are replaced, days without rows have no partition afterwards,
    and days outside the range stay as they are. ``df`` is evaluated once.
    """
    finish(df.sparkSession, path)
    files, run = Files(df.sparkSession, path), uuid.uuid4().hex
    change = changed_days(df.where(on_days(first, last)), path, run, first, last)
    decide(files, run, {day_folder(d): change.digests[d] for d in change.written}, [day_folder(d) for d in change.removed])
    return Published(change.written, change.removed, change.unchanged)


def changed_days(rows: DataFrame, path: str, run: str, first: dt.date, last: dt.date, under: str = "") -> Change:
    """Stage the rows of a range of days, and tell what differs from the days of the table.

    The days lie in the folder ``under`` of the table at ``path``, if one is named.
    """
    spark, inner = rows.sparkSession, f"{under}/" if under else ""
    files, staged = Files(spark, path), f"{staging(path, run)}/{under}".rstrip("/")
    stage_days(rows, staged)
    schema = rows.drop(PART).schema
    digests = _digests(spark.read.schema(schema).parquet(staged))
    days = [first + dt.timedelta(days=k) for k in range((last - first).days + 1)]
    held = _held(spark, files, inner, schema, [d for d in days if d in digests])
    change = Change(digests=digests)
    for day in days:
        if day in digests:
            (change.unchanged if held.get(day) == digests[day] else change.written).append(day)
        elif files.exists(inner + day_folder(day)):
            change.removed.append(day)
    return change


def stage_days(rows: DataFrame, path: str) -> None:
    """Write rows by day, a heavy day in several parts."""
    dealt = rows.drop(PART) if PART in rows.columns else rows.repartition(*PARTITION, part_of(*[c for c in rows.columns if c not in PARTITION]))
    dealt.write.partitionBy(*PARTITION).parquet(path)


def part_of(*columns: str) -> Column:
    """The part of its day that a row belongs to."""
    return F.pmod(F.xxhash64(*columns), F.lit(PARTS))


def _held(spark: SparkSession, files: Files, inner: str, schema, days: list[dt.date]) -> dict[dt.date, list]:
    """Digests of days as they stand: as published if their files are still those, else read anew."""
    known = json.loads(files.read(DIGESTS)) if files.exists(DIGESTS) else {}
    live = {d: names for d in days if (names := files.names(inner + day_folder(d)))}
    entry = {d: known.get(inner + day_folder(d), {}) for d in live}
    found = {d: entry[d]["digest"] for d, names in live.items() if entry[d].get("files") == names}
    others = [f"{files.root}/{inner}{day_folder(d)}" for d in live if d not in found]
    if others:
        # Folder by folder, so that no other day is listed or read.
        found |= _digests(spark.read.schema(schema).option("basePath", f"{files.root}/{inner}").parquet(*others))
    return found
