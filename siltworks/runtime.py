"""Session-level helpers: where shared intermediate tables live and how lineage is cut."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can read.

    It is the session's ``spark.checkpoint.dir``. Only where that is unset and all runs in one
    process (local tests) a temporary folder of this machine is made and remembered in the session;
    on a cluster, whose executors couldn't read it, that is an error.
    """
    got = spark.conf.get(_SETTING, None)
    if not got:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError(f"{_SETTING} has to name a folder that all executors share")
        got = "file://" + tempfile.mkdtemp(prefix="siltworks-")
        spark.conf.set(_SETTING, got)
    return got.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends in a replicated table."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder (used for rounds that nothing reads any more)."""
    p, fs = _at(spark, path)
    fs.delete(p, True)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``materialize`` wrote, once nothing reads them any more."""
    for t in tables:
        shared = urlsplit(shared_dir(t.sparkSession)).path
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            # only what ``scratch`` named, right below the shared folder
            if re.fullmatch(re.escape(shared) + r"/[\w-]+-[0-9a-f]{12}", urlsplit(folder).path):
                remove(t.sparkSession, folder)


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside and put in place in one step."""
    p, fs = _at(spark, path)
    beside, _ = _at(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex[:12]}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    fs.rename(beside, p)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the plans made inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def processes() -> set[int]:
    """The JVM and all processes below it or below this one, without this one.

    They are told by their parent: a process's list of children has only those that its first thread
    started. Under ``spark-submit`` the JVM stands above this process, so it is asked for its number.
    """
    import os
    from pathlib import Path

    from pyspark import SparkContext

    children: dict[int, list[int]] = {}
    for p in Path("/proc").iterdir():
        if p.name.isdigit():
            try:
                parent = int((p / "stat").read_bytes().rpartition(b")")[2].split()[1])
            except OSError:  # ended meanwhile
                continue
            children.setdefault(parent, []).append(int(p.name))
    gateway = SparkContext._gateway
    found = {gateway.jvm.java.lang.ProcessHandle.current().pid()} if gateway else set()
    todo = [os.getpid(), *found]
    while todo:
        below = set(children.get(todo.pop(), ())) - found
        found |= below
        todo += below
    return found - {os.getpid()}


def resources() -> dict[str, float]:
    """Memory in GB of this process and of its ``processes`` (the JVM, Python workers), from the kernel's accounts."""
    import os
    from pathlib import Path

    def amount(pid: int, file: str, key: str) -> int:
        try:
            lines = Path(f"/proc/{pid}/{file}").read_text().splitlines()
        except OSError:
            return 0
        return sum(int(x.split()[1]) for x in lines if x.startswith(f"{key}:")) << 10

    children = processes()
    kinds = {"rss": ("status", "VmRSS"), "pss": ("smaps_rollup", "Pss"), "private_dirty": ("smaps_rollup", "Private_Dirty"), "private_clean": ("smaps_rollup", "Private_Clean")}
    out: dict[str, float] = {"children": float(len(children))}
    for name, (file, key) in kinds.items():
        out[name] = amount(os.getpid(), file, key) / 2**30
        out[f"child_{name}"] = sum(amount(p, file, key) for p in children) / 2**30
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fit_partitions(df: DataFrame, least: int = 4) -> DataFrame:
    """Spread a scan of few splits over the cluster before CPU-heavy work.

    Large scans already have many splits and are returned as they are, without a shuffle.
    """
    spark = df.sparkSession
    want = max(least, spark.sparkContext.defaultParallelism)
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df  # shuffled already; asking for its partitions would run it
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers (once a session)."""
    import os
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if sc.environment.get("SILTWORKS_SHIPPED"):
        return
    package = Path(__file__).resolve().parent
    sc.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [str(package.parent), sc.environment.get("PYTHONPATH", "")]))
    sc.environment["SILTWORKS_SHIPPED"] = "1"
    archive = Path(tempfile.mkdtemp(prefix="siltworks-code-")) / "siltworks.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(archive))  # the driver serves it to every executor
