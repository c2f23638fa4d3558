"""Binary files kept as rows: ``volume_type, volume_name, subdirectory, key,
file_path, value, mime_type, size``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakeretrieve.operators.keyed import mget as keyed_get, requested_rows

# Address kinds, and whether they carry a name.
VOLUME_TYPES = {"user": False, "table": True, "named": True}
DEFAULT_MIME = "application/octet-stream"
ADDRESS = ["volume_type", "volume_name", "subdirectory"]


def check_address(volume_type: str, volume_name: str | None) -> None:
    """Reject an address that has a name it must not have, or lacks one."""
    if volume_type not in VOLUME_TYPES:
        raise ValueError(f"unknown volume type: {volume_type!r}")
    if VOLUME_TYPES[volume_type] and not volume_name:
        raise ValueError(f"a {volume_type} volume needs a name")
    if not VOLUME_TYPES[volume_type] and volume_name:
        raise ValueError("the user volume has no name")


def valid_address(volume_type: Column, volume_name: Column) -> Column:
    """Row-wise form of :func:`check_address`."""
    named = F.coalesce(volume_name, F.lit("")) != ""
    return F.coalesce(
        F.when(volume_type == "user", ~named).when(volume_type.isin("table", "named"), named), F.lit(False)
    )


def volume_uri(volume_type: Column, volume_name: Column) -> Column:
    """Readable address of a volume."""
    return F.when(volume_type == "user", F.lit("volume:user://~/")).otherwise(
        F.concat(F.lit("volume:"), volume_type, F.lit("://"), volume_name, F.lit("/"))
    )


def file_path(key: Column, subdirectory: Column | str | None = None) -> Column:
    """Path of a key inside its volume: subdirectory and hashed file name."""
    name = F.concat(F.sha2(key.cast("binary"), 256), F.lit(".dat"))
    if subdirectory is None:
        return name
    sub = F.lit(subdirectory) if isinstance(subdirectory, str) else subdirectory
    stripped = F.regexp_replace(sub, "^/+|/+$", "")
    return F.concat_ws("/", F.nullif(stripped, F.lit("")), name)


def blob_rows(
    files: DataFrame,
    volume_type: str = "user",
    volume_name: str | None = None,
    subdirectory: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows to store for ``files (key, value[, mime_type])``, with the columns
    of ``keep`` (such as a write order) passed through."""
    check_address(volume_type, volume_name)
    mime = F.col("mime_type") if "mime_type" in files.columns else F.lit(None).cast("string")
    sub = (subdirectory or "").strip("/")
    return files.select(
        F.lit(volume_type).alias("volume_type"),
        F.lit(volume_name or "").alias("volume_name"),
        F.lit(sub).alias("subdirectory"),
        "key",
        file_path(F.col("key"), sub).alias("file_path"),
        F.col("value").cast("binary").alias("value"),
        mime.alias("mime_type"),
        F.octet_length(F.col("value").cast("binary")).cast("bigint").alias("size"),
        *keep,
    )


def whole_files(parts: DataFrame) -> DataFrame:
    """One row a file, with ``size`` and ``value_md5``, from :func:`blob_rows` of file parts that keep ``path, part, md5``."""
    file = [*ADDRESS, "key", "file_path", "mime_type"]
    return (
        parts.groupBy("path", *file)
        .agg(F.sum("size").alias("size"), F.max_by("md5", "part").alias("value_md5"))
        .select(*file, "size", "value_md5")
    )


def put_files(store: DataFrame, files: DataFrame) -> DataFrame:
    """Store after the upsert of file rows with ``ord``; the last one wins."""
    keys = ADDRESS + ["key"]
    rest = [c for c in store.columns if c not in keys]
    newest = (
        files.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "ord").alias("f"))
        .select(*keys, "f.*")
    )
    return store.join(newest.select(*keys), keys, "left_anti").unionByName(newest)


def in_volume(
    store: DataFrame, volume_type: str = "user", volume_name: str | None = None, subdirectory: str | None = None
) -> Column:
    """Whether a row lies at one address; a store without address columns has only one."""
    check_address(volume_type, volume_name)
    address = [volume_type, volume_name or "", (subdirectory or "").strip("/")]
    here = F.lit(True)
    for column, value in zip(ADDRESS, address):
        if column in store.columns:
            here &= F.coalesce(F.col(column), F.lit("")) == value
    return here


def get_bytes(
    requests: DataFrame,
    store: DataFrame,
    volume_type: str = "user",
    volume_name: str | None = None,
    subdirectory: str | None = None,
) -> DataFrame:
    """``(ord, key, value)`` at one address; missing is null, empty bytes are a value."""
    rows = store.filter(in_volume(store, volume_type, volume_name, subdirectory))
    return keyed_get(requests, rows, ["value"], empty_is_null=False)


def get_files(
    requests: DataFrame,
    store: DataFrame,
    volume_type: str = "user",
    volume_name: str | None = None,
    subdirectory: str | None = None,
) -> DataFrame:
    """``(ord, key, value, mime_type)`` at one address; an empty file counts as not found."""
    rows = store.filter((F.col("size") > 0) & in_volume(store, volume_type, volume_name, subdirectory))
    found = requested_rows(requests, rows).select(
        "key", "value", F.coalesce("mime_type", F.lit(DEFAULT_MIME)).alias("mime_type")
    )
    return requests.select("ord", "key").join(found, "key", "inner").select("ord", "key", "value", "mime_type")


def delete_files(
    store: DataFrame,
    keys: DataFrame,
    volume_type: str = "user",
    volume_name: str | None = None,
    subdirectory: str | None = None,
) -> DataFrame:
    """Store without the listed keys of one address; other volumes keep theirs."""
    here = in_volume(store, volume_type, volume_name, subdirectory).alias("__here")
    gone = keys.select(F.col("key").alias("__gone")).distinct()
    kept = store.withColumn("__here", here).join(gone, (F.col("key") == F.col("__gone")) & F.col("__here"), "left_anti")
    return kept.drop("__here")


def drop_volume(store: DataFrame, volume_type: str, volume_name: str | None = None) -> DataFrame:
    """Store without a whole volume, all of its folders included."""
    check_address(volume_type, volume_name)
    name = F.coalesce(F.col("volume_name"), F.lit(""))
    here = F.coalesce((F.col("volume_type") == volume_type) & (name == (volume_name or "")), F.lit(False))
    return store.filter(~here)


def file_keys(
    store: DataFrame,
    prefix: str | None = None,
    volume_type: str = "user",
    volume_name: str | None = None,
    subdirectory: str | None = None,
) -> DataFrame:
    """Sorted keys of one address with a literal prefix."""
    rows = store.filter(in_volume(store, volume_type, volume_name, subdirectory)).select("key")
    if prefix:
        rows = rows.filter(F.col("key").startswith(prefix))
    return rows.orderBy("key")


def list_directory(
    store: DataFrame, subdirectory: str | None = None, volume_type: str = "user", volume_name: str | None = None
) -> DataFrame:
    """Files of a volume below one subdirectory; without one, only those at the root."""
    sub = (subdirectory or "").strip("/")
    path = F.col("file_path")
    inside = path.startswith(sub + "/") if sub else F.instr(path, "/") == 0
    if "subdirectory" in store.columns:
        store = store.drop("subdirectory")
    inside &= in_volume(store, volume_type, volume_name)
    return store.filter(inside).select("file_path", "size").orderBy("file_path")


def list_files(
    store: DataFrame,
    prefix: str | None = None,
    volume_type: str = "user",
    volume_name: str | None = None,
    subdirectory: str | None = None,
) -> DataFrame:
    """``(key, size, mime_type)`` of one address by prefix; the contents are not read.

    As in :func:`get_files`, an empty file does not count.
    """
    rows = store.filter((F.col("size") > 0) & in_volume(store, volume_type, volume_name, subdirectory))
    rows = rows.filter(F.col("key").startswith(prefix)) if prefix else rows
    return rows.select(
        "key", "size", F.coalesce("mime_type", F.lit(DEFAULT_MIME)).alias("mime_type")
    ).orderBy("key")
