"""Session-level helpers: the shared work folder and path checks.

Intermediate files (staged inputs, written tables read back, streaming
checkpoints) go under the folder the cluster names in
``spark.checkpoint.dir`` -- a shared file system every executor and the
driver can see. A cluster without that setting is refused; a local
session gets a folder of its own, registered as checkpoint directory.
"""

from __future__ import annotations

import hashlib
import tempfile

from pyspark.sql import SparkSession

WORK_SUBDIR = "ledgerloom"


def shared_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="ledgerloom-checkpoints-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_root(spark), WORK_SUBDIR, *parts])


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (works
    for local, HDFS and object stores alike)."""
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def path_bytes(spark: SparkSession, path: str) -> int:
    """Length of a file, or of all files of a folder (metadata only)."""
    fs, p = _fs_and_path(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Short key from the length and modification time of input paths, so
    staged copies are rebuilt when the inputs change."""
    h = hashlib.sha1()
    for path in paths:
        fs, p = _fs_and_path(spark, path)
        if fs.exists(p):
            st = fs.getFileStatus(p)
            h.update(f"{path}|{st.getLen()}|{st.getModificationTime()}".encode())
        else:
            h.update(f"{path}|missing".encode())
    return h.hexdigest()[:12]


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob (file-system metadata only, no data)."""
    fs, p = _fs_and_path(spark, pattern)
    found = fs.globStatus(p) or []
    return [str(st.getPath().toString()) for st in found]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that the library wrote itself, if it is there."""
    fs, p = _fs_and_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def swap_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the folder ``fresh`` in the place of ``path``: two renames in
    one file system. The old folder is removed last; if the second rename
    fails, it goes back."""
    fs, target = _fs_and_path(spark, path)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old = Path(f"{fresh}-old")
    had = fs.exists(target)
    fs.mkdirs(target.getParent())
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(Path(fresh), target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot move the new table to {path}")
    if had:
        fs.delete(old, True)


def move_files(spark: SparkSession, moves: list[tuple[str, str]], target_dir: str) -> int:
    """Move many files into ``target_dir`` (file-system metadata only).
    The folder is emptied first, so a rerun after a failure starts clean;
    one file-system handle serves every move. Returns the number moved."""
    jvm = spark.sparkContext._jvm
    fs, folder = _fs_and_path(spark, target_dir)
    if fs.exists(folder):
        fs.delete(folder, True)
    fs.mkdirs(folder)
    Path = jvm.org.apache.hadoop.fs.Path
    return sum(bool(fs.rename(Path(src), Path(dst))) for src, dst in moves)
