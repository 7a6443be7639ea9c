"""Queries that move real files. Spark first writes every document as a file of its own."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.inputs import FILES_SQL, FROM_S, LOGICAL_START_MS, TO_S, document_files, in_window_sql, instant, table
from tidemark.functions import crypto
from tidemark.functions.paths import relative_path
from tidemark.operators.filters import delta_filter
from tidemark.operators.ledger import read_ledger
from tidemark.operators.split import CRC_MARK, copy_by_ranges, ranges_of
from tidemark.operators.transfer import plan_transfer, transfer, write_files
from tidemark.operators.trees import audit_trees, differing_trees
from tidemark.operators.verify import verify
from tidemark.options import TransferOptions
from tidemark.plans.run import RunResult, run_transfer
from tidemark.session import materialize, new_folder, shared_folder
from tidemark.sources.content import checksum_files, read_content
from tidemark.sources.fs import make_folder, strip_file_scheme
from tidemark.sources.datasource import FORMAT, register
from tidemark.sources.listing import place_kinds, scan_files, walk_files
from tidemark.sources.manifest import store_manifest
from tidemark.sources.ranges import folder_pager, list_level
from tidemark.sources.watermark import read_watermark_texts
from tidemark.streaming.files import append_stream, stream_listing, stream_transfer

QUERIES = {}
SQL = {}

# A start late enough for all files.
ALL_MS = 2_000_000_000_000
# Bytes of a range in the query of copies by ranges.
_RANGE = 1_000
# Seconds that a stream's file has to stand.
_LAG_S = 2
_EXPORTED: dict[tuple[str, str], str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql.strip()
        return function

    return register


def _contents(spark: SparkSession, sf_dir: str, name: Column | None = None, text: Column | None = None) -> DataFrame:
    """relpath, content, mtime_s of every document, and its id."""
    leaf = F.concat("doc_id", F.lit(".txt")) if name is None else name
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws("/", "source", "lang", leaf).alias("relpath"),
        F.encode(F.col("text") if text is None else text, "UTF-8").alias("content"),
    )
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), F.unix_seconds(instant("ts")).alias("mtime_s")
    )
    return documents.join(events, "doc_id")


def _fresh(spark: SparkSession, contents: DataFrame) -> str:
    """A new folder with ``in`` holding the contents, and empty ``out`` and ``done`` beside it."""
    base = new_folder(spark, "files")
    write_files(contents, f"{base}/in")
    for name in ("out", "done"):
        make_folder(f"{base}/{name}")
    return base


def _exported(spark: SparkSession, sf_dir: str) -> str:
    """The documents as files, written once per application for the queries that only read them."""
    known = (shared_folder(spark) + spark.sparkContext.applicationId, sf_dir)
    if known not in _EXPORTED:
        _EXPORTED[known] = _fresh(spark, _contents(spark, sf_dir)) + "/in"
    return _EXPORTED[known]


def _run(spark: SparkSession, source: str, target: str, run_id: str = "run-1", logical_ms: int = ALL_MS,
         **settings) -> RunResult:
    options = {"pipeline": "documents", "recursive": True, "wait_s": 0, "user": "u", "host": "h", **settings}
    return run_transfer(spark, TransferOptions(source_root=source, target_root=target, **options), run_id, logical_ms)


def _target(spark: SparkSession) -> str:
    folder = new_folder(spark, "target")
    make_folder(folder)
    return folder


# --- listings -------------------------------------------------------------------


@query(f"with {FILES_SQL} select relpath, size, mtime_s from files")
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file below a folder, by the distributed walk."""
    return walk_files(spark, _exported(spark, sf_dir)).select("relpath", "size", "mtime_s")


@query(f"with {FILES_SQL} select relpath, size, mtime_s from files where {in_window_sql('mtime_s')}")
def file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window by times: pruned while listing, then exact."""
    files = scan_files(spark, _exported(spark, sf_dir), FROM_S, TO_S)
    return delta_filter(files, FROM_S, TO_S, on="mtime").select("relpath", "size", "mtime_s")


@query("select doc_id || '.txt' as relpath, strlen(text)::bigint as size from documents where lang = 'en'")
def folder_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder without what lies deeper: English files are in it, the others in folders below."""
    folder = F.when(F.col("lang") != "en", F.col("lang"))
    files = table(spark, sf_dir, "documents").select(
        F.concat_ws("/", folder, F.concat("doc_id", F.lit(".txt"))).alias("relpath"),
        F.encode("text", "UTF-8").alias("content"),
    )
    return walk_files(spark, f"{_fresh(spark, files)}/in", recursive=False).select("relpath", "size")


@query(f"""
with {FILES_SQL}
select 'documents' as listed_from, relpath, size from files
union all select 'pages', page_id || '.html', strlen(html)::bigint from pages
""")
def several_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders in one listing."""
    pages = table(spark, sf_dir, "pages").select(
        F.concat("page_id", F.lit(".html")).alias("relpath"), F.encode("html", "UTF-8").alias("content")
    )
    documents_in, pages_in = _exported(spark, sf_dir), f"{_fresh(spark, pages)}/in"
    listed_from = F.when(F.col("root") == strip_file_scheme(pages_in), "pages").otherwise("documents")
    return walk_files(spark, [documents_in, f"{pages_in}/"]).select(listed_from.alias("listed_from"), "relpath", "size")


@query(f"with {FILES_SQL} select relpath, md5, size from files")
def file_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole contents as rows."""
    base = _exported(spark, sf_dir)
    below = relative_path("path", strip_file_scheme(base)).alias("relpath")
    return read_content(spark, base).select(below, crypto.content_md5("content").alias("md5"), "size")


@query(f"with {FILES_SQL} select relpath, md5 from files")
def file_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of files of any size, one buffer at a time."""
    return checksum_files(walk_files(spark, _exported(spark, sf_dir))).select("relpath", "md5")


@query(f"""
with {FILES_SQL}
select relpath, size, mtime_s from files
where starts_with(relpath, 'src1') and {in_window_sql('mtime_s')} and ends_with(relpath, '4.txt') and size >= 1000
""")
def source_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder as a data source; the conditions reach the lister, and folders outside the prefix are not opened."""
    files = register(spark).read.format(FORMAT).load(_exported(spark, sf_dir))
    wanted = files.where(F.col("relpath").startswith("src1") & F.col("name").endswith("4.txt") & (F.col("size") >= 1000))
    return delta_filter(wanted, FROM_S, TO_S).select("relpath", "size", "mtime_s")


@query("select doc_id || '.txt' as name, strlen(text)::bigint as size from documents")
def range_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in one folder, listed by ranges of names that split where they are full."""
    files = table(spark, sf_dir, "documents").select(
        F.concat("doc_id", F.lit(".txt")).alias("relpath"), F.encode("text", "UTF-8").alias("content")
    )
    return list_level(spark, folder_pager(f"{_fresh(spark, files)}/in"), limit=200).select("name", "size")


@query("""
select distinct source as name, 'folder' as kind from documents
union all select n_name, 'missing' from nation
union all select source || '/' || lang || '/' || min(doc_id) || '.txt', 'file' from documents group by source, lang
""")
def missing_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which roots are there, before anything is listed."""
    documents = table(spark, sf_dir, "documents")
    folders = documents.select(F.col("source").alias("name")).distinct()
    files = documents.groupBy("source", "lang").agg(F.min("doc_id").alias("first"))
    names = folders.unionByName(table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))).unionByName(
        files.select(F.concat_ws("/", "source", "lang", F.concat("first", F.lit(".txt"))).alias("name"))
    )
    base = _exported(spark, sf_dir)
    return place_kinds(names.withColumn("path", F.concat(F.lit(f"{base}/"), "name"))).select("name", "kind")


# --- transfers -------------------------------------------------------------------


@query(f"""
with {FILES_SQL}
select relpath, '/' || relpath as filename, size as bytes, md5 as md5_source, md5 as md5_target, 'copied' as status,
       1 as attempts, 'verified' as "check", 'application/octet-stream' as content_type
from files where mtime_s <= {TO_S}
""")
def copy_to_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run from a remote folder to the store."""
    run = _run(spark, _exported(spark, sf_dir), _target(spark), logical_ms=LOGICAL_START_MS)
    return run.ledger.select(
        "relpath", "filename", "bytes", "md5_source", "md5_target", "status", "attempts", "check", "content_type"
    )


@query(f"""
with {FILES_SQL}
select relpath, doc_id || '.txt' as filename, size as bytes, md5 as md5_target, 'verified' as "check" from files
where regexp_full_match(doc_id || '.txt', '[0-9]+\\.txt')
""")
def copy_to_remote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other direction, by name."""
    run = _run(spark, _exported(spark, sf_dir), _target(spark), direction="to_sftp", regex=r"[0-9]+\.txt")
    return run.ledger.select("relpath", "filename", "bytes", "md5_target", "check")


@query(f"""
with {FILES_SQL}
select relpath, size as bytes, greatest(1, ceil(size / {_RANGE}.0))::bigint as ranges, 'copied' as status, 1 as attempts, true as crc_agrees, md5
from files
""")
def split_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files copied by ranges, whose checksums combine to that of a plain pass; here of a range size that cuts most documents."""
    source, target = _exported(spark, sf_dir), _target(spark)
    plan = plan_transfer(store_manifest(walk_files(spark, source), "store", "gs://bucket/in"), target)
    done = materialize(copy_by_ranges(plan, range_bytes=_RANGE), "split")
    ranges = ranges_of(plan, _RANGE).groupBy("relpath").agg(F.count("*").alias("ranges"))
    plain = read_content(spark, target).select(
        relative_path("path", strip_file_scheme(target)).alias("relpath"), crypto.content_md5("content").alias("md5"),
        F.concat(F.lit(CRC_MARK), F.lower(F.lpad(F.hex(F.crc32("content")), 8, "0"))).alias("crc"),
    )
    agrees = (F.col("md5_source") == F.col("crc")) & (F.col("md5_target") == F.col("crc"))
    return done.join(ranges, "relpath").join(plain, "relpath").select(
        "relpath", "bytes", "ranges", "status", "attempts", agrees.alias("crc_agrees"), "md5"
    )


@query(f"""with {FILES_SQL} select relpath, md5 as md5_source, md5 as md5_target, 'verified' as "check" from files""")
def audited_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a copy, both folders are listed and hashed again and joined by path."""
    source, target = _exported(spark, sf_dir), _target(spark)
    manifest = store_manifest(walk_files(spark, source), "store", "gs://bucket/in")
    transfer(plan_transfer(manifest, target), wait_s=0)
    stored = checksum_files(walk_files(spark, target))
    return verify(checksum_files(walk_files(spark, source)), stored, unique=True)


@query(f"""
with {FILES_SQL}
select relpath, md5 as md5_source, case when doc_id in (select doc_id from labels) then md5(lang) else md5 end as md5_target,
       case when doc_id in (select doc_id from labels) then 'mismatch' else 'verified' end as "check"
from files
""")
def audit_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a copy some files were written over: folders are compared as a whole, files only where folders differ."""
    source, target = _exported(spark, sf_dir), _target(spark)
    transfer(plan_transfer(store_manifest(walk_files(spark, source), "store", "gs://bucket/in"), target), wait_s=0)
    labels = table(spark, sf_dir, "labels").select("doc_id")
    write_files(_contents(spark, sf_dir, text=F.col("lang")).join(labels, "doc_id", "left_semi").drop("mtime_s"), target)
    sides = [materialize(checksum_files(walk_files(spark, uri)), "digests") for uri in (source, target)]
    return audit_trees(*sides)


@query(f"""
with {FILES_SQL}, differing as (
  select source, lang, doc_id in (select doc_id from labels) as written from files
), folders as (
  select '' as folder, 0 as depth, written from differing union all select source, 1, written from differing
  union all select source || '/' || lang, 2, written from differing
)
select folder, depth, count(*) as files_source, count(*) as files_target from folders group by folder, depth having bool_or(written)
""")
def differing_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sub-trees differ, from the root down, where the texts of labelled documents were written over."""
    files, labels = document_files(spark, sf_dir), table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("written"))
    digest = F.when(F.col("written"), F.md5("lang")).otherwise(F.col("md5"))
    target = files.join(labels.distinct(), "doc_id", "left").withColumn("md5", digest)
    return differing_trees(files, target)


@query(f"""
with {FILES_SQL}
select relpath || '.pgp' as relpath, 'application/octet-stream' as content_type, size as bytes, md5 as md5_target,
       size + 20 + 32 * greatest(1, ceil(size / 1048576.0))::bigint as sealed_bytes, 'verified' as "check"
from files
""")
def sealed_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sealed on the way to the store, opened on the way back."""
    base, sealed, opened = new_folder(spark, "key"), _target(spark), _target(spark)
    key = table(spark, sf_dir, "region").select(
        F.lit("key").alias("relpath"), F.unhex(F.sha2("r_name", 256)).alias("content")
    )
    write_files(key.groupBy("relpath").agg(F.max("content").alias("content")), base)
    secret = {"encryption": "aes_gcm", "key_uri": f"{base}/key"}
    _run(spark, _exported(spark, sf_dir), sealed, **secret)
    # The sealed copies carry the time they were made, which is before this run's end.
    back = _run(spark, sealed, opened, direction="to_sftp", **secret)
    return back.ledger.select(
        "relpath", "content_type", "bytes", "md5_target", F.col("size").alias("sealed_bytes"), "check"
    )


@query(f"""
with {FILES_SQL}
select '/' || relpath as file, 'run-1' as run_id, metric,
       case metric when 'created_on' then mtime_s when 'size_bytes' then size when 'seen_on' then {ALL_MS} // 1000
       when 'transfer_retries' then 0 else 1 end as value
from files, (select unnest(['created_on', 'size_bytes', 'seen_on', 'transfer_retries', 'total_uploaded_files']) as metric)
""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run measured, but for the clock times."""
    source = _exported(spark, sf_dir)
    run = _run(spark, source, _target(spark))
    prefix = len(f"sftp://u@h:22{strip_file_scheme(source)}")
    return run.metrics.where(~F.col("metric").isin("transferred_on", "transfer_time")).select(
        F.substr("file", F.lit(prefix + 1)).alias("file"), "run_id", "metric", "value"
    )


# --- state across runs -------------------------------------------------------------


@query(f"""
with {FILES_SQL}
select relpath, case when mtime_s <= {TO_S} then 'run-1' else 'run-2' end as run_id from files
""")
def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive windows have no gap and no overlap; a third run finds nothing."""
    source, target, state = _exported(spark, sf_dir), _target(spark), new_folder(spark, "state")
    for run_id, logical_ms in (("run-1", LOGICAL_START_MS), ("run-2", ALL_MS), ("run-3", ALL_MS)):
        _run(spark, source, target, run_id, logical_ms, state_root=state)
    return read_ledger(spark, f"{state}/ledger").select("relpath", "run_id")


@query(f"""
with {FILES_SQL}
select relpath, case when doc_id in (select doc_id from labels) then 'run-2' else 'run-1' end as run_id from files
""")
def late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive with an old time are found by looking back, and nothing is sent twice."""
    contents, labels = _contents(spark, sf_dir), table(spark, sf_dir, "labels").select("doc_id")
    base, state = _fresh(spark, contents.join(labels, "doc_id", "left_anti")), new_folder(spark, "state")
    _run(spark, f"{base}/in", f"{base}/out", "run-1", state_root=state)
    write_files(contents.join(labels, "doc_id", "left_semi"), f"{base}/in")
    _run(spark, f"{base}/in", f"{base}/out", "run-2", state_root=state, lookback_s=ALL_MS // 1000)
    return read_ledger(spark, f"{state}/ledger").select("relpath", "run_id")


@query(f"""
with {FILES_SQL}
select relpath, size as bytes, 'run-1' as run_id from files
union all
select relpath, strlen(d.text || d.lang)::bigint, 'run-2' from files join documents d using (doc_id) where doc_id in (select doc_id from labels)
""")
def rewritten_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that is written again goes again, with its new bytes."""
    contents, state = _contents(spark, sf_dir), new_folder(spark, "state")
    labels = table(spark, sf_dir, "labels").select("doc_id")
    base = _fresh(spark, contents)
    _run(spark, f"{base}/in", f"{base}/out", "run-1", state_root=state)
    later = _contents(spark, sf_dir, text=F.concat("text", "lang")).join(labels, "doc_id", "left_semi")
    write_files(later.withColumn("mtime_s", F.lit(ALL_MS // 1000 + 1)), f"{base}/in")
    _run(spark, f"{base}/in", f"{base}/out", "run-2", ALL_MS + 400_000, state_root=state)
    return read_ledger(spark, f"{state}/ledger").select("relpath", "bytes", "run_id")


@query(f"""
with {FILES_SQL}
select relpath, case when doc_id in (select doc_id from labels) then 'failed' else 'copied' end as status,
       case when doc_id in (select doc_id from labels) then 3 else 1 end as attempts
from files
""")
def retried_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two retries are three attempts; here a folder is in the way of every labelled document's copy."""
    labels = table(spark, sf_dir, "labels").select("doc_id")
    target = _target(spark)
    blocked = _contents(spark, sf_dir).join(labels, "doc_id", "left_semi").select(
        F.concat("relpath", F.lit("/in-the-way")).alias("relpath"), F.lit(b"").alias("content")
    )
    write_files(blocked, target)
    run = _run(spark, _exported(spark, sf_dir), target, retries=2)
    return run.ledger.select("relpath", "status", "attempts")


_DAY_S = 86_400


@query(f"""
select n_nationkey || '.txt' as file_name, (case when n_nationkey % 4 = 0 then {FROM_S} + n_nationkey * {_DAY_S} else 0 end)::bigint as from_s
from nation
""")
def unreadable_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State that cannot be read means the beginning: here every fourth text is a time, the others are cut, padded or no number."""
    key, seconds = F.col("n_nationkey"), F.lit(FROM_S) + F.col("n_nationkey") * _DAY_S
    text = (
        F.when(key % 4 == 0, seconds.cast("string")).when(key % 4 == 1, F.substring(seconds.cast("string"), 1, 8))
        .when(key % 4 == 2, F.col("n_name")).otherwise(F.concat(seconds.cast("string"), F.lit("000")))
    )
    states = table(spark, sf_dir, "nation").select(
        F.concat(key, F.lit(".txt")).alias("relpath"), F.encode(text, "UTF-8").alias("content")
    )
    folder = _target(spark)
    write_files(states, folder)
    return read_watermark_texts(spark, folder).select("file_name", "from_s")


@query(f"with {FILES_SQL} select relpath, size as bytes, md5, size as listed, mtime_s from files")
def sink_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as files by Spark's own writer: all staged, then published by one commit."""
    target, outcome = _target(spark), new_folder(spark, "outcome")
    contents = _contents(spark, sf_dir).select("relpath", "content", "mtime_s")
    register(spark)
    contents.write.format(FORMAT).mode("append").option("outcome", outcome).save(target)
    written = spark.read.parquet(outcome).select("relpath", "bytes", "md5")
    listed = walk_files(spark, target).select("relpath", F.col("size").alias("listed"), "mtime_s")
    return written.join(listed, "relpath")


# --- originals ---------------------------------------------------------------------


def _places(spark: SparkSession, **folders: str) -> DataFrame:
    """What lies where now."""
    listed = [walk_files(spark, uri).select(F.lit(name).alias("place"), "relpath", "size") for name, uri in folders.items()]
    places = listed[0]
    for more in listed[1:]:
        places = places.unionByName(more)
    return places


@query(f"""
with {FILES_SQL}
select 'target' as place, relpath, size from files union all select 'archive', relpath, size from files
""")
def archive_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Originals of a remote folder keep their sub-tree in the archive."""
    base = _fresh(spark, _contents(spark, sf_dir))
    _run(spark, f"{base}/in", f"{base}/out", archive="rename", archive_root=f"{base}/done")
    return _places(spark, source=f"{base}/in", target=f"{base}/out", archive=f"{base}/done")


@query("""
with files as (
  select source || '/' || lang || '/' || doc_id || '/' || n_chars || '.txt' as relpath, n_chars || '.txt' as leaf,
         strlen(text)::bigint as size, count(*) over (partition by n_chars) as n
  from documents join events on event_id = doc_id
)
select 'target' as place, relpath, size from files
union all select 'archive', leaf, size from files where n = 1
union all select 'source', relpath, size from files where n > 1
""")
def archive_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Originals of the store are archived by leaf name; equal names stay where they are."""
    leaf = F.concat("doc_id", F.lit("/"), "n_chars", F.lit(".txt"))
    base = _fresh(spark, _contents(spark, sf_dir, leaf))
    _run(spark, f"{base}/in", f"{base}/out", direction="to_sftp", archive="rename", archive_root=f"{base}/done")
    return _places(spark, source=f"{base}/in", target=f"{base}/out", archive=f"{base}/done")


@query(f"""
with {FILES_SQL}
select relpath, case when mtime_s <= {TO_S} then 'removed' else 'listed' end as archive_status from files
""")
def remove_originals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed after their copy was verified; files outside the window are left."""
    base = _fresh(spark, _contents(spark, sf_dir))
    run = _run(spark, f"{base}/in", f"{base}/out", logical_ms=LOGICAL_START_MS, archive="remove")
    left = walk_files(spark, f"{base}/in").select("relpath", F.lit("listed").alias("archive_status"))
    return run.archived.select("relpath", "archive_status").unionByName(left)


# --- streams ------------------------------------------------------------------------


# Names and contents that a file source may pass over: hidden ones, and nothing at all.
_ODD_SQL = """
odd as (
  select d.source || '/' || case d.lang when 'fr' then '_' when 'de' then '.' else '' end || d.doc_id as relpath,
         case when d.lang = 'es' then '' else d.text end as content, floor(epoch(e.ts))::bigint as mtime_s
  from documents d join events e on e.event_id = d.doc_id
)"""


def _odd(spark: SparkSession, sf_dir: str, text: str = "text") -> DataFrame:
    mark = F.when(F.col("lang") == "fr", "_").when(F.col("lang") == "de", ".").otherwise("")
    name = F.concat(mark, "doc_id")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat("source", F.lit("/"), name).alias("relpath"),
        F.encode(F.when(F.col("lang") == "es", "").otherwise(F.expr(text)), "UTF-8").alias("content"),
    )
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), F.unix_seconds(instant("ts")).alias("mtime_s"))
    return documents.join(events, "doc_id").drop("doc_id")


@query(f"with {_ODD_SQL} select relpath, strlen(content)::bigint as size, mtime_s from odd")
def stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New files as a stream, empty and hidden ones too, drained into a table; a second drain adds nothing."""
    source, found, checkpoint = f"{_fresh(spark, _odd(spark, sf_dir))}/in", new_folder(spark, "found"), new_folder(spark, "checkpoint")
    for _ in range(2):
        append_stream(stream_listing(spark, source), found, checkpoint).awaitTermination()
    return spark.read.parquet(found).select("relpath", "size", "mtime_s")


@query(f"""
with {_ODD_SQL}
select relpath, strlen(content)::bigint as bytes, md5(content) as md5_target, 'verified' as "check" from odd
""")
def stream_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every micro-batch is copied, checked and accounted for."""
    state, source = new_folder(spark, "state"), f"{_fresh(spark, _odd(spark, sf_dir))}/in"
    manifest = store_manifest(stream_listing(spark, source), "store", "gs://bucket/in")
    stream_transfer(manifest, _target(spark), f"{state}/ledger", f"{state}/checkpoint", "stream", wait_s=0).awaitTermination()
    return read_ledger(spark, f"{state}/ledger").select("relpath", "bytes", "md5_target", "check")


@query(f"""
with {_ODD_SQL}
select relpath, strlen(content)::bigint as bytes, md5(content) as md5_target, 1 as times from odd
""")
def stream_holdback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are still being written wait: seen half written, then whole, each is copied once, whole."""
    state, base = new_folder(spark, "state"), _fresh(spark, _odd(spark, sf_dir, "substring(text, 1, length(text) div 2)"))

    def drain() -> None:
        manifest = store_manifest(stream_listing(spark, f"{base}/in", lag_s=_LAG_S), "store", "gs://bucket/in")
        stream_transfer(manifest, f"{base}/out", f"{state}/ledger", f"{state}/checkpoint", "stream", wait_s=0).awaitTermination()

    drain()
    write_files(_odd(spark, sf_dir), f"{base}/in")
    drain()
    time.sleep(_LAG_S)
    drain()
    copied = read_ledger(spark, f"{state}/ledger").groupBy("relpath").agg(
        F.max("bytes").alias("bytes"), F.max("md5_target").alias("md5_target"), F.count("*").cast("int").alias("times")
    )
    return copied
