"""Directory algebra over path columns: the relative path without suffix is the key that all manifests join on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def relative(path: Column, root: str) -> Column:
    """The path below ``root``; the root is anchored at the front, unlike a plain replacement."""
    base = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(base)), F.substring(path, F.lit(len(base) + 1), F.length(path))).otherwise(path)


def name_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_of(path: Column) -> Column:
    """The directory of a path; empty for a bare name."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def extension_of(path: Column) -> Column:
    """The suffix without its dot; a leading dot is part of a name."""
    return F.regexp_extract(name_of(path), r"^.+\.([^.]*)$", 1)


def stem_of(path: Column) -> Column:
    return F.regexp_replace(name_of(path), r"(?<=.)\.[^.]*$", "")


def rerooted(path: Column, old: str, new: str, suffix: str | None = None) -> Column:
    """The path below another root, with another suffix if one is given."""
    moved = F.concat(F.lit(new.rstrip("/") + "/"), relative(path, old))
    return moved if suffix is None else F.regexp_replace(moved, r"(?<=[^/])\.[^./]*$", suffix)


def with_parts(df: DataFrame, path: str = "path", root: str = "") -> DataFrame:
    """``df`` with rel_path, dir, name, stem and ext."""
    rel = relative(F.col(path), root) if root else F.col(path)
    return df.withColumn("rel_path", rel).withColumns({
        "dir": parent_of(F.col("rel_path")), "name": name_of(F.col("rel_path")), "stem": stem_of(F.col("rel_path")), "ext": extension_of(F.col("rel_path")),
    })


def all_dirs(files: DataFrame, path: str = "rel_path") -> DataFrame:
    """(dir) of every directory that holds a file or a directory with one; the root itself is left out."""
    parts = F.split(parent_of(F.col(path)), "/")
    upto = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    return files.select(F.explode(upto).alias("dir")).where("dir <> ''").distinct()


def leaf_dirs(files: DataFrame, path: str = "rel_path") -> DataFrame:
    """(dir) of the directories without subdirectories."""
    dirs = all_dirs(files, path)
    parents = dirs.select(parent_of(F.col("dir")).alias("dir")).distinct()
    return dirs.join(parents, "dir", "left_anti")


def dirs_with(files: DataFrame, ext: str, path: str = "rel_path") -> DataFrame:
    """(dir) of the directories that hold a file with the extension, leaf or not; the root's is empty."""
    return files.where(extension_of(F.col(path)) == ext).select(parent_of(F.col(path)).alias("dir")).distinct()


def dir_depths(files: DataFrame, path: str = "rel_path") -> DataFrame:
    """(dir, depth): layers below a directory, a leaf having 1."""
    dirs = all_dirs(files, path)
    below = F.transform(F.sequence(F.lit(1), F.size(F.split("dir", "/"))), lambda k: F.array_join(F.slice(F.split("dir", "/"), 1, k), "/"))
    own = F.size(F.split("dir", "/"))
    deep = dirs.select(F.explode(below).alias("above"), own.alias("deep")).groupBy("above").agg(F.max("deep").alias("deep"))
    return deep.select(F.col("above").alias("dir"), (F.col("deep") - F.size(F.split("above", "/")) + 1).cast("long").alias("depth"))


def small_dirs(files: DataFrame, fewer: int = 3, path: str = "rel_path") -> DataFrame:
    """(dir, n) of the leaf directories with fewer entries than asked."""
    counts = files.groupBy(parent_of(F.col(path)).alias("dir")).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") < fewer).join(leaf_dirs(files, path), "dir", "left_semi")


def offset_names(files: DataFrame, start: int, path: str = "rel_path") -> DataFrame:
    """Files whose stems are numbers, renamed by adding an offset; nothing is moved."""
    number = stem_of(F.col(path)).try_cast("long")
    fresh = F.concat_ws("/", F.nullif(parent_of(F.col(path)), F.lit("")), F.concat((number + start).cast("string"), F.lit("."), extension_of(F.col(path))))
    return files.withColumn("new_path", F.when(number.isNotNull(), fresh))
