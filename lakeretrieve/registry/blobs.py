"""Queries on binary files."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeretrieve.operators import blobs as op
from lakeretrieve.registry.base import Tables, query
from lakeretrieve.sources.files import PART_BYTES, import_directory

# Pages are files; the kind of a URL decides the volume they go to.
_FILES_SQL = """files AS (
  SELECT url AS key, encode(html) AS value, page_id AS ord,
    CASE WHEN starts_with(url, 'https://m.') THEN 'named' WHEN starts_with(url, 'https') THEN 'table' ELSE 'user' END AS volume_type,
    CASE WHEN starts_with(url, 'https://m.') THEN 'mobile' WHEN starts_with(url, 'https') THEN 'pages' ELSE '' END AS volume_name
  FROM pages),
store AS (
  SELECT volume_type, volume_name, key, arg_max(value, ord) AS value, sha256(key) || '.dat' AS file_path
  FROM files GROUP BY ALL)"""


def _raw(t: Tables):
    return t.read("pages").select(
        F.col("url").alias("key"),
        F.encode("html", "UTF-8").alias("value"),
        F.lit("text/html").alias("mime_type"),
        F.col("page_id").alias("ord"),
        F.when(F.col("url").startswith("https://m."), "named")
        .when(F.col("url").startswith("https"), "table")
        .otherwise("user")
        .alias("kind"),
    )


def _files(t: Tables):
    """Rows of all three address kinds, with the order of their writes."""
    names = {"user": None, "table": "pages", "named": "mobile"}
    parts = [
        op.blob_rows(_raw(t).filter(F.col("kind") == kind), kind, name, keep=["ord"]) for kind, name in names.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _store(t: Tables):
    last = _raw(t).groupBy("key").agg(F.max_by(F.struct("value", "mime_type"), "ord").alias("f"))
    return op.blob_rows(last.select("key", "f.*"))


_ONE_SQL = """store AS (
  SELECT url AS key, arg_max(html, page_id) AS html, sha256(url) || '.dat' AS file_path FROM pages GROUP BY url)"""


@query("b01_file_path", "SELECT url AS key, 'site/' || sha256(url) || '.dat' AS path, sha256(url) || '.dat' AS root_path FROM pages")
def paths(t: Tables):
    return t.read("pages").select(
        F.col("url").alias("key"),
        op.file_path(F.col("url"), "/site/").alias("path"),
        op.file_path(F.col("url"), "//").alias("root_path"),
    )


@query(
    "b03_addresses",
    f"""WITH {_FILES_SQL} SELECT volume_type, volume_name, count(*) AS files, sum(octet_length(value))::BIGINT AS bytes,
          TRUE AS valid,
          CASE volume_type WHEN 'user' THEN 'volume:user://~/' ELSE 'volume:' || volume_type || '://' || volume_name || '/' END AS uri
        FROM store GROUP BY ALL""",
)
def addresses(t: Tables):
    rows = _files(t)
    empty = rows.drop("ord").limit(0)
    store = op.put_files(empty, rows)
    return store.groupBy("volume_type", "volume_name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    ).select(
        "*",
        op.valid_address(F.col("volume_type"), F.col("volume_name")).alias("valid"),
        op.volume_uri(F.col("volume_type"), F.col("volume_name")).alias("uri"),
    )


@query(
    "b04_put_bytes",
    f"""WITH {_FILES_SQL},
      later AS (SELECT 'table' AS volume_type, 'pages' AS volume_name, key, max(ord) AS ord FROM files WHERE volume_type = 'table' GROUP BY key)
      SELECT s.volume_type, s.volume_name, s.key, s.file_path,
        CASE WHEN l.key IS NULL THEN md5(decode(s.value)) ELSE md5('page ' || l.ord) END AS value_md5
      FROM store s LEFT JOIN later l USING (volume_type, volume_name, key)""",
)
def put_bytes(t: Tables):
    """All pages are stored, then the table volume is overwritten."""
    rows = _files(t)
    store = op.put_files(rows.drop("ord").limit(0), rows)
    again = _raw(t).filter("kind = 'table'").groupBy("key").agg(F.max("ord").alias("ord"))
    value = F.encode(F.concat(F.lit("page "), F.col("ord").cast("string")), "UTF-8")
    newer = op.blob_rows(again.withColumn("value", value), "table", "pages", keep=["ord"])
    return op.put_files(store, newer).select(
        "volume_type", "volume_name", "key", "file_path", F.md5("value").alias("value_md5")
    )


@query(
    "b05_get_bytes",
    f"""WITH {_ONE_SQL}, r AS (SELECT page_id AS ord, url AS key FROM pages
          UNION ALL SELECT 100000 + item_id, 'missing/' || item_id FROM benchmark)
      SELECT ord, key, md5(html) AS value_md5 FROM r LEFT JOIN store USING (key)""",
)
def get_bytes(t: Tables):
    requests = t.read("pages").select(F.col("page_id").alias("ord"), F.col("url").alias("key")).unionByName(
        t.read("benchmark").select(
            (F.col("item_id") + 100000).alias("ord"),
            F.concat(F.lit("missing/"), F.col("item_id").cast("string")).alias("key"),
        )
    )
    return op.get_bytes(requests, _store(t)).select("ord", "key", F.md5("value").alias("value_md5"))


@query(
    "b06_delete_bytes",
    f"WITH {_ONE_SQL} SELECT key FROM store WHERE key NOT IN (SELECT url FROM pages WHERE contains(html, '***'))",
)
def delete_bytes(t: Tables):
    gone = t.read("pages").filter(F.contains("html", F.lit("***"))).select(F.col("url").alias("key"))
    return op.delete_files(_store(t), gone).select("key")


@query("b07_yield_keys", f"WITH {_ONE_SQL} SELECT key FROM store WHERE starts_with(key, 'https://m.') ORDER BY key")
def keys(t: Tables):
    return op.file_keys(_store(t), "https://m.")


def _in_folders(t: Tables):
    """Pages stored below their site language, pages with a query at the root."""
    rows = _raw(t).drop("kind", "ord").dropDuplicates(["key"])
    folder = F.when(F.contains("key", F.lit("?")), "").otherwise(F.regexp_extract("key", r"/(en|fr|de|es)/", 1))
    return rows.select(
        "key", op.file_path(F.col("key"), folder).alias("file_path"), F.octet_length("key").cast("bigint").alias("size")
    )


_FOLDERS_SQL = """f AS (SELECT DISTINCT url AS key,
  CASE WHEN contains(url, '?') THEN '' ELSE regexp_extract(url, '/(en|fr|de|es)/', 1) END AS folder FROM pages)"""


@query(
    "b08_list_directory",
    f"WITH {_FOLDERS_SQL} SELECT 'en/' || sha256(key) || '.dat' AS file_path, octet_length(encode(key))::BIGINT AS size FROM f WHERE folder = 'en'",
)
def list_directory(t: Tables):
    return op.list_directory(_in_folders(t), "/en/")


@query(
    "b08_list_root",
    f"WITH {_FOLDERS_SQL} SELECT sha256(key) || '.dat' AS file_path, octet_length(encode(key))::BIGINT AS size FROM f WHERE folder = ''",
)
def list_root(t: Tables):
    return op.list_directory(_in_folders(t))


@query(
    "b09_store_files",
    f"WITH {_ONE_SQL} SELECT key, file_path, 'text/html' AS mime_type, octet_length(encode(html))::BIGINT AS size FROM store",
)
def store_files(t: Tables):
    return _store(t).select("key", "file_path", "mime_type", "size")


_MIXED_SQL = """mixed AS (
  SELECT 'doc/' || doc_id AS key, CASE lang WHEN 'fr' THEN '' ELSE text END AS body,
    CASE lang WHEN 'de' THEN NULL ELSE 'text/plain' END AS mime FROM documents)"""


def _mixed(t: Tables):
    """Documents as files: some empty, some without a MIME type."""
    return op.blob_rows(
        t.read("documents").select(
            F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("key"),
            F.encode(F.when(F.col("lang") == "fr", "").otherwise(F.col("text")), "UTF-8").alias("value"),
            F.when(F.col("lang") != "de", "text/plain").alias("mime_type"),
        )
    )


@query(
    "b10_get_files",
    f"""WITH {_MIXED_SQL} SELECT l.doc_id AS ord, key, md5(body) AS value_md5, coalesce(mime, 'application/octet-stream') AS mime_type
        FROM labels l JOIN mixed ON key = 'doc/' || l.doc_id WHERE body <> ''""",
)
def get_files(t: Tables):
    requests = t.read("labels").select(
        F.col("doc_id").alias("ord"), F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("key")
    )
    return op.get_files(requests, _mixed(t)).select("ord", "key", F.md5("value").alias("value_md5"), "mime_type")


@query(
    "b11_list_files",
    f"""WITH {_MIXED_SQL} SELECT key, octet_length(encode(body))::BIGINT AS size, coalesce(mime, 'application/octet-stream') AS mime_type
        FROM mixed WHERE body <> '' AND starts_with(key, 'doc/1')""",
)
def list_files(t: Tables):
    return op.list_files(_mixed(t), "doc/1")


@query(
    "b12_file_store",
    f"""WITH {_MIXED_SQL}, r AS (
          SELECT key, body, mime FROM mixed WHERE key NOT IN (SELECT 'doc/' || doc_id FROM labels)
          UNION ALL SELECT 'raw/' || item_id, text, NULL FROM benchmark)
        SELECT key, md5(body) AS value_md5, mime AS mime_type FROM r""",
)
def file_store(t: Tables):
    """Raw mset adds files without a MIME type; mdelete drops files whole."""
    raw = t.read("benchmark").select(
        F.concat(F.lit("raw/"), F.col("item_id").cast("string")).alias("key"),
        F.encode("text", "UTF-8").alias("value"),
    )
    rows = op.blob_rows(raw).withColumn("ord", F.lit(0))
    gone = t.read("labels").select(F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("key"))
    kept = op.delete_files(op.put_files(_mixed(t), rows), gone)
    return kept.select("key", F.md5("value").alias("value_md5"), "mime_type")


# The same keys in three places: table and named volume, and a folder of the latter.
_PLACES_SQL = """one AS (SELECT url AS key, arg_max(html, page_id) AS html FROM pages GROUP BY url),
places AS (
  SELECT 'table' AS volume_type, 'pages' AS volume_name, '' AS subdirectory, key, html FROM one
  UNION ALL SELECT 'named', 'mobile', '', key, 'm ' || html FROM one
  UNION ALL SELECT 'named', 'mobile', 'old', key, 'o ' || html FROM one),
asked AS (SELECT DISTINCT url AS key FROM pages WHERE contains(html, '***'))"""


def _places(t: Tables):
    last = _raw(t).groupBy("key").agg(F.max_by(F.struct("value", "mime_type"), "ord").alias("f")).select("key", "f.*")

    def marked(mark):
        return last.withColumn("value", F.concat(F.encode(F.lit(mark), "UTF-8"), F.col("value")))

    store = op.blob_rows(last, "table", "pages").unionByName(op.blob_rows(marked("m "), "named", "mobile"))
    return store.unionByName(op.blob_rows(marked("o "), "named", "mobile", "/old/"))


def _asked(t: Tables):
    return t.read("pages").filter(F.contains("html", F.lit("***"))).select(F.col("url").alias("key")).distinct()


@query(
    "b05_get_bytes_volume",
    f"""WITH {_PLACES_SQL} SELECT page_id AS ord, key, md5(places.html) AS value_md5 FROM pages JOIN places ON key = url
        WHERE volume_type = 'named' AND subdirectory = ''""",
)
def get_bytes_volume(t: Tables):
    requests = t.read("pages").select(F.col("page_id").alias("ord"), F.col("url").alias("key"))
    return op.get_bytes(requests, _places(t), "named", "mobile").select("ord", "key", F.md5("value").alias("value_md5"))


@query(
    "b06_delete_bytes_volume",
    f"""WITH {_PLACES_SQL} SELECT volume_type, volume_name, subdirectory, key, md5(html) AS value_md5 FROM places
        WHERE NOT (volume_type = 'named' AND subdirectory = '' AND key IN (SELECT key FROM asked))""",
)
def delete_bytes_volume(t: Tables):
    kept = op.delete_files(_places(t), _asked(t), "named", "mobile")
    return kept.select("volume_type", "volume_name", "subdirectory", "key", F.md5("value").alias("value_md5"))


@query(
    "b06_drop_volume",
    f"WITH {_PLACES_SQL} SELECT volume_type, volume_name, subdirectory, key FROM places WHERE volume_type <> 'named'",
)
def drop_volume(t: Tables):
    return op.drop_volume(_places(t), "named", "mobile").select("volume_type", "volume_name", "subdirectory", "key")


@query(
    "b07_yield_keys_volume",
    f"""WITH {_PLACES_SQL} SELECT key FROM places
        WHERE volume_type = 'table' AND starts_with(key, 'https://m.') ORDER BY key""",
)
def keys_volume(t: Tables):
    return op.file_keys(_places(t), "https://m.", "table", "pages")


@query(
    "b08_list_directory_volume",
    f"""WITH {_PLACES_SQL} SELECT 'old/' || sha256(key) || '.dat' AS file_path, octet_length(encode(html))::BIGINT AS size
        FROM places WHERE subdirectory = 'old'""",
)
def list_directory_volume(t: Tables):
    return op.list_directory(_places(t), "old", "named", "mobile")


@query(
    "b10_get_files_volume",
    f"""WITH {_PLACES_SQL} SELECT 0 AS ord, key, md5(html) AS value_md5, 'text/html' AS mime_type FROM places
        WHERE subdirectory = 'old' AND key IN (SELECT key FROM asked)""",
)
def get_files_volume(t: Tables):
    requests = _asked(t).select(F.lit(0).alias("ord"), "key")
    found = op.get_files(requests, _places(t), "named", "mobile", "old")
    return found.select("ord", "key", F.md5("value").alias("value_md5"), "mime_type")


@query(
    "b11_list_files_volume",
    f"""WITH {_PLACES_SQL} SELECT key, octet_length(encode(html))::BIGINT AS size, 'text/html' AS mime_type
        FROM places WHERE volume_type = 'named' AND subdirectory = ''""",
)
def list_files_volume(t: Tables):
    return op.list_files(_places(t), None, "named", "mobile")


@query("b13_import_directory")
def import_files(t: Tables):
    """The table files themselves as a directory of binary files."""
    files = import_directory(t.spark, t.dir, "*.parquet", PART_BYTES)
    parts = op.blob_rows(files.select("key", "value", "mime_type", "path", "part", "md5"), keep=["path", "part", "md5"])
    return op.whole_files(parts).select("key", "file_path", "mime_type", "size", "value_md5")
