"""Session and shared-folder helpers.

Streaming checkpoints, replay staging and state tables must live in a folder
every executor and the driver can see.  On a cluster that folder is the one
named by ``spark.checkpoint.dir``; it is read from the session.  Only a local
master (tests, bench) may fall back to a fresh temporary folder, and only when
the setting is unset.
"""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "fadeclust") -> SparkSession:
    """Session used by tests and the bench (local mode, UI off, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def _configured_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    try:
        d = sc.getCheckpointDir()
    except Exception:  # pragma: no cover - very old pyspark
        d = None
    if d:
        return d
    return sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)


def shared_dir(spark: SparkSession) -> str:
    """Base folder for checkpoints and derived tables.

    Uses the cluster's ``spark.checkpoint.dir``.  When it is unset and the
    master is local, a temporary folder is created and registered as the
    checkpoint dir (the test setting); on a cluster an unset dir is an error.
    """
    d = _configured_dir(spark)
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a folder shared by "
            "all executors (HDFS/S3/NFS) before running streaming jobs")
    d = tempfile.mkdtemp(prefix="fadeclust-")
    spark.sparkContext.setCheckpointDir(d)
    return _configured_dir(spark).rstrip("/")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique sub-folder of :func:`shared_dir` for one run."""
    return f"{shared_dir(spark)}/fadeclust/{purpose}-{uuid.uuid4().hex[:12]}"


def arrow_fs(uri: str):
    """``(pyarrow FileSystem, path)`` for a URI Spark would accept: local
    paths, ``file:/..``, ``hdfs://..``, ``s3://..``.  Usable on the driver and
    inside tasks."""
    import pyarrow.fs as pafs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


# A listing that meets a folder which goes meanwhile starts again, this often.
LIST_TRIES = 20


def list_dir(uri: str, recursive: bool = False) -> list:
    """File infos below a folder; empty if there is no such folder.  Folders may
    come and go while they are listed: the listing is then made again."""
    import pyarrow.fs as pafs
    fs, base = arrow_fs(uri)
    for attempt in range(LIST_TRIES):
        try:
            return fs.get_file_info(pafs.FileSelector(base, allow_not_found=True, recursive=recursive))
        except FileNotFoundError:
            if fs.get_file_info(base).type == 0:
                return []
            if attempt == LIST_TRIES - 1:
                raise
            time.sleep(0.002 * attempt)
    return []


def remove_dir(uri: str) -> None:
    """Delete a folder this library made (a staged copy no longer needed)."""
    fs, base = arrow_fs(uri)
    if fs.get_file_info(base).type != 0:
        fs.delete_dir(base)


def read_small_text(uri: str) -> str | None:
    """The text of a small file, or None if it does not exist."""
    fs, base = arrow_fs(uri)
    if fs.get_file_info(base).type == 0:
        return None
    with fs.open_input_stream(base) as f:
        return f.read().decode("utf-8")


def write_small_text(root: str, name: str, text: str) -> None:
    """Publish a small driver-side file ``root/name`` whole: it is written
    under ``root/_tmp`` (a name that Spark's readers skip) and moved over an
    earlier version in one step, which is never deleted first.  A file that
    already holds this text is left alone, so a re-run batch changes nothing.
    For model-sized or one-row outputs."""
    if read_small_text(f"{root}/{name}") == text:
        return
    fs, base = arrow_fs(root)
    tmp = f"{base}/_tmp/{uuid.uuid4().hex}"
    fs.create_dir(f"{base}/_tmp", recursive=True)
    with fs.open_output_stream(tmp) as out:
        out.write(text.encode("utf-8"))
    final = f"{base}/{name}"
    fs.create_dir(final.rsplit("/", 1)[0], recursive=True)
    fs.move(tmp, final)
