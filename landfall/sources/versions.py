"""Published versions of a lake.

A run writes its tables into new folders, ``<table>/<run>``. Nothing reads them until a manifest, one
small numbered file, names them: the manifest with the highest number is the lake. It is written
aside and renamed into place, so readers see all tables of a run or none, and a run that fails or is
killed leaves the lake as it was. Partitioned tables are named partition by partition, so that a
refresh writes only what it replaces.

A manifest maps each table to its parts, and a part to the run's folder that holds it:
``{"fact": {"": "fact/run-1"}}`` or ``{"fact": {"year=2016/month=4": "fact/run-2", ...}}``.
"""

import json
import re
import time
import uuid

from py4j.protocol import Py4JJavaError

from landfall.sources.paths import join_path

MANIFESTS = "_manifests"
#: Folder name of a partition whose value is NULL.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
_NUMBERED = re.compile(r"([0-9]{10})\.json")


class PublishConflict(RuntimeError):
    """Another run has published a table that this run was built on."""


def new_run():
    """A name for a run's folders; names sort by the time at which runs began."""
    return f"run-{time.strftime('%Y%m%d%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"


def _open(spark, text):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark, output):
    path, files = _open(spark, join_path(output, MANIFESTS))
    if not files.exists(path):
        return []
    found = (_NUMBERED.fullmatch(s.getPath().getName()) for s in files.listStatus(path))
    return sorted(int(m[1]) for m in found if m)


def _manifest(output, number):
    return join_path(output, f"{MANIFESTS}/{number:010d}.json")


def read_manifest(spark, output, number=None):
    """(number, tables) of the newest manifest or of the one asked for; (0, {}) if there is none."""
    if number is None:
        number = max(_numbers(spark, output), default=0)
    if not number:
        return 0, {}
    path, files = _open(spark, _manifest(output, number))
    stream = files.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return number, json.loads(text)


def written_parts(spark, output, folder, partitions):
    """The parts that a run wrote into ``folder``: one, or one for each partition folder."""
    if not partitions:
        return {"": folder}
    path, files = _open(spark, join_path(output, f"{folder}{'/*=*' * len(partitions)}"))
    depth = len(partitions)
    found = files.globStatus(path) or ()
    return {"/".join(str(s.getPath()).split("/")[-depth:]): folder for s in found}


def table_parts(spark, output, table, partitions=()):
    """The parts of a table in the newest manifest.

    A table that was written straight into ``<output>/<table>``, without a manifest, is found there;
    {} if there is none.
    """
    tables = read_manifest(spark, output)[1]
    if table in tables:
        return tables[table]
    path, files = _open(spark, join_path(output, table))
    if not files.exists(path):
        return {}
    if partitions:
        return written_parts(spark, output, table, partitions)
    plain = any(s.isFile() and s.getPath().getName().endswith(".parquet") for s in files.listStatus(path))
    return {"": table} if plain else {}


def part_frames(spark, output, parts, schema):
    """One frame for every run's folder among ``parts``, under ``schema``, partition columns included."""
    folders = {}
    for part, folder in parts.items():
        folders.setdefault(folder, []).append(part)
    frames = []
    for folder in sorted(folders):
        base, named = join_path(output, folder), sorted(folders[folder])
        depth = named[0].count("/") + 1 if named[0] else 0
        # A folder of which all parts count is read by its listing, without naming each.
        whole = not depth or len(written_parts(spark, output, folder, range(depth))) == len(named)
        paths = [base] if whole else [f"{base}/{part}" for part in named]
        frames.append(spark.read.schema(schema).option("basePath", base).parquet(*paths))
    return frames or [spark.createDataFrame([], schema)]


def read_parts(spark, output, parts, schema):
    """The rows of ``parts`` as one frame."""
    first, *rest = part_frames(spark, output, parts, schema)
    for rows in rest:
        first = first.unionByName(rows)
    return first


def publish(spark, output, tables, seen=None):
    """Make ``tables`` ({table: parts}) the lake's, beside the tables that they do not name.

    ``seen`` ({table: parts}) is what the run was built on: if another run has replaced one of these
    since, nothing is published. Returns the number of the manifest. The rename refuses to replace a
    file where the file system can do so at once (HDFS, local); elsewhere let one run publish at a time.
    """
    jvm = spark._jvm
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    none[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    while True:
        number, current = read_manifest(spark, output)
        for table, parts in (seen or {}).items():
            if table in current and current[table] != parts:
                raise PublishConflict(f"{table} was published by another run")
        aside, files = _open(spark, join_path(output, f"{MANIFESTS}/.{uuid.uuid4().hex}"))
        stream = files.create(aside, False)
        stream.write(bytearray(json.dumps(current | tables, sort_keys=True).encode()))
        stream.close()
        final, _ = _open(spark, _manifest(output, number + 1))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.makeQualified(aside).toUri(), spark._jsc.hadoopConfiguration())
        try:
            context.rename(files.makeQualified(aside), files.makeQualified(final), none)
            return number + 1
        except Py4JJavaError as failure:
            files.delete(aside, False)
            if not files.exists(final):
                raise
            # Another run was faster: look at what it published, then try the next number.
            if "FileAlreadyExists" not in failure.java_exception.toString():
                raise


def remove_old(spark, output, keep=2, idle_hours=24.0):
    """Delete the folders of runs that none of the ``keep`` newest manifests names, and older manifests.

    Runs younger than ``idle_hours`` stay, since they may still be writing. Returns the folders deleted.
    """
    numbers = _numbers(spark, output)
    kept = numbers[-keep:]
    tables, named = set(), set()
    for number in numbers:
        for table, parts in read_manifest(spark, output, number)[1].items():
            tables.add(table)
            if number in kept:
                named |= set(parts.values())
    last = f"run-{time.strftime('%Y%m%d%H%M%S', time.gmtime(time.time() - idle_hours * 3600))}"
    gone = []
    for table in sorted(tables):
        path, files = _open(spark, join_path(output, table))
        for status in files.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("run-") and f"{table}/{name}" not in named and name < last:
                files.delete(status.getPath(), True)
                gone.append(f"{table}/{name}")
    for number in numbers[:-keep]:
        path, files = _open(spark, _manifest(output, number))
        files.delete(path, False)
    return gone
