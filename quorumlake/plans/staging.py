"""Tables written to the folder that all executors share, to cut lineage.

An executor can be lost at any time, so nothing here relies on blocks that only
one executor holds: a staged table is Parquet in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset a local session, as in tests, gets a folder of its own;
    on a cluster, whose machines would not see one another's, that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="quorumlake-")
    return _OWN[app]


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/staged/{tag}-{uuid.uuid4().hex}"


_SCOPES: list[list[str]] = []


class Scope:
    """Within ``with Scope(spark) as made`` all staged tables are noted; at the end those go that ``made.keep`` did
    not name. What it named belongs to the scope around, if any."""

    def __init__(self, spark: SparkSession):
        self.spark, self.kept = spark, set()

    def keep(self, *staged: DataFrame) -> None:
        """``staged`` is what ``Stage.put`` returned; a plan that a caller gets must read nothing else."""
        self.kept |= {d.staged_path for d in staged}

    def __enter__(self) -> Scope:
        _SCOPES.append([])
        return self

    def __exit__(self, kind, *_) -> None:
        made = _SCOPES.pop()
        for path in made:
            if path not in self.kept:
                remove(self.spark, path)
        if _SCOPES:
            _SCOPES[-1] += [path for path in made if path in self.kept]


class Stage:
    """Staged tables of one operator call; ``drop`` removes those that no later plan reads."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.tag, self.paths = spark, tag, {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, f"{self.tag}-{name}")
        df.write.parquet(path)
        self.paths.setdefault(name, []).append(path)
        if _SCOPES:
            _SCOPES[-1].append(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.staged_path = path
        return out

    def drop(self, name: str, keep_last: bool = False) -> None:
        paths = self.paths.get(name, [])
        gone, self.paths[name] = (paths[:-1], paths[-1:]) if keep_last else (paths, [])
        for path in gone:
            remove(self.spark, path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
