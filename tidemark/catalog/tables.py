"""Queries over manifests, ledgers and watermarks that are tables already."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.inputs import (
    FILES_SQL,
    FROM_S,
    LEDGER_SQL,
    LOGICAL_START_MS,
    TO_S,
    document_files,
    document_ledger,
    in_window_sql,
    instant,
    table,
)
from tidemark.functions import crypto
from tidemark.functions import paths as P
from tidemark.functions import times as T
from tidemark.operators import filters, ledger, metrics
from tidemark.operators.snapshot import with_runs, write_snapshot
from tidemark.operators.transfer import discard, plan_transfer
from tidemark.operators.verify import lookup_objects, verify
from tidemark.session import new_folder
from tidemark.sources.manifest import sftp_manifest, store_manifest
from tidemark.sources.watermark import commit_watermark, latest_watermarks, read_watermark

QUERIES = {}
SQL = {}


def query(sql: str):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def register(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql.strip()
        return function

    return register


# --- windows and filters -------------------------------------------------------

_NAMES = r"[0-9]+\.txt"


@query(f"""
with {FILES_SQL}
select relpath, 'sftp://u@h:22' || path as fullfilename, '/' || relpath as filename,
       regexp_extract(path, '^(.*/)', 1) as basename, size, mtime_s, 'landing/' || relpath as target
from files where {in_window_sql('mtime_s')} and regexp_full_match(doc_id || '.txt', '{_NAMES}')
""")
def delta_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run lists: the files of the window, by name, with the names they get."""
    files = document_files(spark, sf_dir, (FROM_S, TO_S))
    manifest = sftp_manifest(filters.name_filter(files, _NAMES), "remote", "u", "h")
    return manifest.select(
        "relpath", "fullfilename", "filename", "basename", "size", "mtime_s",
        P.target_object_name("/landing/", "filename").alias("target"),
    )


@query(f"""
select event_id, floor(epoch(ts))::bigint as mtime_s from events
where floor(epoch(ts)) > {FROM_S} and floor(epoch(ts)) <= {LOGICAL_START_MS} // 1000 - 300
""")
def delta_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window on the timestamp itself, pushed to the scan."""
    events = filters.delta_filter(table(spark, sf_dir, "events").select("event_id", "ts"), FROM_S, TO_S, on="ts")
    return events.select("event_id", F.unix_seconds(instant("ts")).alias("mtime_s"))


@query(f"""
with objects as (
  select event_id, epoch_us(ts) // 1000000 as created_s,
         event_type || '/' || case when event_type = 'error' then '' else event_id::varchar end as name
  from events
)
select event_id, name, created_s from objects where {in_window_sql('created_s')} and not ends_with(name, '/')
""")
def store_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window on creation time in milliseconds, without folder placeholders."""
    leaf = F.when(F.col("event_type") == "error", "").otherwise(F.col("event_id").cast("string"))
    objects = filters.delta_filter(table(spark, sf_dir, "events"), FROM_S, TO_S, on="ts").select(
        "event_id",
        F.concat("event_type", F.lit("/"), leaf).alias("name"),
        T.ms_to_s(F.unix_millis(instant("ts"))).alias("created_s"),
    )
    return filters.delta_filter(filters.regular_files(objects, on="name"), FROM_S, TO_S, on="created_s")


@query("""
select page_id, string_split(url, '/')[-1] as leaf from pages
where regexp_full_match(string_split(url, '/')[-1], '[0-9]+(\\.html)?')
""")
def regex_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole leaf names only; a name that merely contains a match is out."""
    pages = filters.name_filter(table(spark, sf_dir, "pages"), r"[0-9]+(\.html)?", on="url")
    return pages.select("page_id", P.leaf("url").alias("leaf"))


_BY_LANGUAGE_SQL = """
listed as (
  select case lang when 'en' then '' else lang || '/' end || doc_id || '.txt' as relpath, strlen(text)::bigint as size
  from documents union all select case lang when 'en' then '' else lang || '/' end, 0 from documents
)"""


def _by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English files at the root, the others in a folder each, and placeholders for the folders."""
    folder = F.when(F.col("lang") == "en", "").otherwise(F.concat("lang", F.lit("/")))
    documents = table(spark, sf_dir, "documents")
    files = documents.select(
        F.concat(folder, "doc_id", F.lit(".txt")).alias("relpath"), F.octet_length("text").cast("bigint").alias("size")
    )
    return files.unionByName(documents.select(folder.alias("relpath"), F.lit(0).cast("bigint").alias("size")))


@query(f"""
with {_BY_LANGUAGE_SQL} select relpath, size from listed where relpath not like '%/%' and relpath <> ''
""")
def direct_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files directly in the root; its own placeholder and those of its folders are no files."""
    return filters.regular_files(filters.subtree_filter(_by_language(spark, sf_dir), ""))


@query(f"""
with {_BY_LANGUAGE_SQL} select relpath, size from listed where starts_with(relpath, 'fr/') and not ends_with(relpath, '/')
""")
def subtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files below a folder."""
    return filters.regular_files(filters.subtree_filter(_by_language(spark, sf_dir), "fr", recursive=True))


@query("""
select c_custkey, c_name as filename, 'customer-' || c_nationkey as connection_ref from customer
""")
def connection_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows name their connection; what opens it stays behind."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_name").alias("filename"),
        F.concat(F.lit("customer-"), "c_nationkey").alias("connection_ref"),
        F.concat(F.lit('{"password":"'), "c_acctbal", F.lit('"}')).alias("connection"),
        F.lit("json").alias("connectionType"),
    )
    return filters.without_secrets(rows, keep=("c_custkey",))


# --- paths ---------------------------------------------------------------------

def _escape_sql(name: str) -> str:
    sql = f"url_encode({name})"
    for char in "!$'()*,;&=@:+/?":
        quoted = "''" if char == "'" else char
        sql = f"replace({sql}, '%{ord(char):02X}', '{quoted}')"
    return sql


@query(f"""
with parsed as (
  select page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) as bucket,
         regexp_extract(url, '^[a-z]+://[^/]+/(.*)$', 1) as name, string_split(url, '/')[-1] as leaf from pages
)
select page_id, bucket, name, 'gs://' || bucket || '/' || {_escape_sql('name')} as uri,
       regexp_full_match(bucket, '[a-z0-9._-]+') as valid, leaf, name = '' as is_root,
       '/' || bucket || '/' || name as full_name
from parsed
""")
def object_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, object name and escaped URI of every address."""
    parsed = table(spark, sf_dir, "pages").select("page_id", "url", P.parse_object_uri("url").alias("object"))
    return parsed.select(
        "page_id",
        "object.*",
        P.leaf("url").alias("leaf"),
        P.is_bucket_root("object.name").alias("is_root"),
        P.store_full_name("object.bucket", "object.name").alias("full_name"),
    )


@query(f"""
select conv_id, turn, length({_escape_sql('text')})::bigint as escaped_length, md5({_escape_sql('text')}) as escaped_md5
from conversations
""")
def escaped_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percent-encoding of free text: accents, line breaks and reserved characters."""
    escaped = P.escape_object_name("text")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.length(escaped).cast("bigint").alias("escaped_length"), F.md5(escaped).alias("escaped_md5")
    )


@query(f"""
with {FILES_SQL}
select 'remote' as connection_ref, 'sftp://u@h:22' || path as fullfilename,
       substring(path, length('/in') + 1) as filename, regexp_extract(path, '^(.*/)', 1) as basename,
       relpath, size, mtime_s
from files
""")
def sftp_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sftp_manifest(document_files(spark, sf_dir), "remote", "u", "h").drop("mtime", "path")


@query(f"""
with {FILES_SQL}
select 'store' as connection_ref, '/bucket/in/' || relpath as fullfilename, doc_id || '.txt' as filename,
       '/bucket/in/' as basename, relpath, size, mtime_s
from files
""")
def store_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_manifest(document_files(spark, sf_dir), "store", "gs://bucket/in").drop("mtime", "path")


@query("""
with bare as (select page_id, regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*:/+', '/') as root from pages)
select page_id, case when ends_with(root, '/') then root else root || '/' end as root from bare
""")
def root_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", P.normalise_root("url").alias("root"))


@query(f"""
with {FILES_SQL}
select relpath, array_to_string(list_filter(string_split(regexp_extract(path, '^(.*/)', 1), '/'), lambda x: x <> ''), '>')
  as folders
from files
""")
def folder_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folders a target needs, outermost first."""
    return document_files(spark, sf_dir).select("relpath", F.array_join(P.folders("path"), ">").alias("folders"))


@query(f"""
with {FILES_SQL}
select relpath, 'landing/day/' || relpath as in_store, relpath as in_bucket_root, '/' || relpath as at_remote from files
""")
def target_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in both directions; the bucket root adds no slash."""
    files = document_files(spark, sf_dir)
    below = P.below_root("path", "/in")
    return files.select(
        "relpath",
        P.target_object_name("/landing/day/", below).alias("in_store"),
        P.target_object_name("/", below).alias("in_bucket_root"),
        P.target_relative_path("path", F.lit("/in/")).alias("at_remote"),
    )


@query(f"""
with {FILES_SQL}
select relpath, '/done/' || relpath as kept, '/in/src1/en/' || doc_id || '.txt' as flat,
       path = '/in/src1/en/' || doc_id || '.txt' as same_path
from files
""")
def archive_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where originals go, with and without their folders, and which would stay where they are."""
    flat = P.archive_path("/in/src1/en", "relpath", flatten=True)
    return document_files(spark, sf_dir).select(
        "relpath",
        P.archive_path("/done/", "relpath").alias("kept"),
        flat.alias("flat"),
        (F.col("path") == flat).alias("same_path"),
    )


@query(f"""
with {FILES_SQL}, named as (
  select relpath, relpath || case lang when 'fr' then '.pgp' when 'de' then '-pgp' else '' end as name from files
)
select relpath, name, ends_with(name, '.pgp') as encrypted, regexp_replace(name, '\\.pgp$', '') as plain_name,
       name || '.pgp' as sealed_name,
       case when ends_with(name, '.pgp') then 'application/pgp-encrypted' else 'application/octet-stream' end
         as content_type
from named
""")
def content_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suffix decides; its dot is part of it."""
    ending = F.when(F.col("lang") == "fr", ".pgp").when(F.col("lang") == "de", "-pgp").otherwise("")
    named = document_files(spark, sf_dir).select("relpath", F.concat("relpath", ending).alias("name"))
    return named.select(
        "relpath",
        "name",
        P.is_encrypted("name").alias("encrypted"),
        P.strip_suffix("name").alias("plain_name"),
        P.add_suffix("name").alias("sealed_name"),
        P.content_type(P.is_encrypted("name")).alias("content_type"),
    )


@query("""
with typed as (select c_custkey, c_nationkey, ' Port:' || c_nationkey || ' , User:' || c_name || ',Port:22,' ||
  case c_mktsegment when 'MACHINERY' then 'StrictHostKeyChecking:yes' else 'Proxy:a:b' end as text from customer)
select c_custkey, ' Port=' || c_nationkey || ';Port=22;' ||
  case when text like '%Strict%' then 'StrictHostKeyChecking=yes' else 'Proxy=a:b;StrictHostKeyChecking=no' end
  || ';User=' || regexp_extract(text, 'User:([^,]*)', 1) as properties
from typed
""")
def property_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and value text over a default; the last value of a key counts."""
    tail = F.when(F.col("c_mktsegment") == "MACHINERY", "StrictHostKeyChecking:yes").otherwise("Proxy:a:b")
    text = F.concat(F.lit(" Port:"), "c_nationkey", F.lit(" , User:"), "c_name", F.lit(",Port:22,"), tail)
    properties = P.property_map(text, {"StrictHostKeyChecking": "no"})
    pairs = F.transform(F.array_sort(F.map_entries(properties)), lambda pair: F.concat(pair["key"], F.lit("="), pair["value"]))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(pairs, ";").alias("properties"))


@query("""
select c_custkey, coalesce(nullif(c_mktsegment, 'MACHINERY'), '') = '' as blank,
       case when c_mktsegment = 'BUILDING' then c_mktsegment else '/' || c_mktsegment end as message_path
from (select c_custkey, c_mktsegment from customer)
""")
def blank_and_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing text is blank text; a message drops one leading slash only."""
    slashes = F.when(F.col("c_mktsegment") == "BUILDING", "/").otherwise("//")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        P.is_blank(F.nullif("c_mktsegment", F.lit("MACHINERY"))).alias("blank"),
        P.strip_leading_slash(F.concat(slashes, "c_mktsegment")).alias("message_path"),
    )


# --- times -----------------------------------------------------------------------

_NOW_S = 1_629_205_254


@query("""
with runs as (
  select o_orderkey, epoch_ms(o_orderdate) + o_custkey as logical_ms, o_custkey as safety,
         case when o_orderstatus = 'F' then o_custkey end as explicit,
         case when o_orderpriority <> '5-LOW' then o_orderkey end as persisted
  from orders
)
select o_orderkey, logical_ms // 1000 - safety as to_s, coalesce(explicit, persisted, 0)::bigint as from_s from runs
""")
def window_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends of a run's window."""
    runs = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.unix_millis(instant("o_orderdate")) + F.col("o_custkey")).alias("logical_ms"),
        F.col("o_custkey").alias("safety"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("explicit"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("persisted"),
    )
    return runs.select(
        "o_orderkey",
        T.upper_bound("logical_ms", "safety").alias("to_s"),
        T.lower_bound("explicit", "persisted").alias("from_s"),
    )


@query("""
with texts as (
  select o_orderkey, case o_orderstatus when 'O' then o_custkey::varchar when 'F' then '-' || (o_custkey + 1)
         else o_orderpriority end as text from orders
)
select o_orderkey, case when try_cast(text as bigint) >= 0 then try_cast(text as bigint) else 300 end as lag_s
from texts
""")
def safety_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        F.when(F.col("o_orderstatus") == "O", F.col("o_custkey").cast("string"))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("-"), F.col("o_custkey") + 1))
        .otherwise(F.col("o_orderpriority"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", T.safety_lag(text).alias("lag_s"))


_WATERMARK_TEXT_SQL = """
texts as (
  select o_orderkey, case o_orderpriority when '1-URGENT' then epoch(o_orderdate)::bigint::varchar || chr(10)
         when '2-HIGH' then '16292O5254' when '3-MEDIUM' then (4816407641 + o_custkey)::varchar
         when '5-LOW' then null else (1000000000 + o_orderkey)::varchar end as text
  from orders
)"""


def _watermark_case_sql(text: str) -> str:
    return f"""case when coalesce(length({text}), 0) <> 10 then 'bad_length'
       when not regexp_full_match({text}, '[+-]?[0-9]+') then 'not_numeric'
       when try_cast({text} as bigint) > {_NOW_S} then 'future' else 'ok' end"""


@query(f"""
with {_WATERMARK_TEXT_SQL}
select o_orderkey, {_watermark_case_sql('trim(text, chr(10))')} as status, {_watermark_case_sql('text')} as legacy_status
from texts
""")
def watermark_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persisted text: ten digits, not in the future; a line end only matters to the old reading."""
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", F.concat(F.unix_seconds(instant("o_orderdate")).cast("string"), F.lit("\n")))
        .when(priority == "2-HIGH", "16292O5254")
        .when(priority == "3-MEDIUM", (F.lit(4_816_407_641) + F.col("o_custkey")).cast("string"))
        .when(priority != "5-LOW", (F.lit(1_000_000_000) + F.col("o_orderkey")).cast("string"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        T.watermark_status(text, _NOW_S).alias("status"),
        T.watermark_status(text, _NOW_S, legacy=True).alias("legacy_status"),
    )


@query("""
select o_orderpriority as pipeline, max_by(o_custkey, o_orderkey) as from_s,
       max_by(epoch(o_orderdate)::bigint, o_orderkey) as to_s, max_by(o_orderkey::varchar, o_orderkey) as run_id
from orders group by 1
""")
def latest_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last commit of every pipeline; here one pipeline per priority, committed in key order."""
    commits = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("pipeline"),
        F.col("o_custkey").alias("from_s"),
        F.unix_seconds(instant("o_orderdate")).alias("to_s"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.timestamp_seconds("o_orderkey").alias("committed_at"),
    )
    return latest_watermarks(commits).drop("committed_at")


@query("""
select 'events' as pipeline, floor(epoch(min(ts)))::bigint as from_s, floor(epoch(max(ts)))::bigint as to_s,
       'first' as run_id from events
""")
def commit_and_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State is kept across commits; neither a preview nor an earlier end moves it."""
    seconds = F.unix_seconds(instant("ts"))
    span = table(spark, sf_dir, "events").agg(F.min(seconds).alias("low"), F.max(seconds).alias("high")).first()
    state = new_folder(spark, "watermarks")
    commit_watermark(spark, state, "events", span.low, span.high, "first")
    commit_watermark(spark, state, "events", span.low, span.low, "earlier")
    commit_watermark(spark, state, "events", span.high, span.high + 1, "preview", preview=True)
    row = read_watermark(spark, state, "events")
    return spark.createDataFrame(
        [(row.pipeline, row.from_s, row.to_s, row.run_id)], "pipeline string, from_s bigint, to_s bigint, run_id string"
    )


# --- digests and encryption -------------------------------------------------------


@query("select doc_id, md5(text) as md5, strlen(text)::bigint as size from documents")
def checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, not characters."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        crypto.content_md5(F.encode("text", "UTF-8")).alias("md5"),
        F.octet_length("text").cast("bigint").alias("size"),
    )


def _table_key(spark: SparkSession, sf_dir: str):
    """A 32-byte key out of a table, as a scalar subquery; real keys come from a file."""
    return table(spark, sf_dir, "region").agg(F.unhex(F.sha2(F.max("r_name"), 256)).alias("key")).scalar()


@query("""
select doc_id, md5(text) as md5, strlen(text)::bigint + 28 as sealed_size, true as differs,
       'failed' as misplaced_status
from documents
""")
def aes_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sealed and opened again; opened in another place it fails instead of giving wrong bytes."""
    key, place = _table_key(spark, sf_dir), F.col("doc_id").cast("string")
    plain = F.encode("text", "UTF-8")
    sealed = table(spark, sf_dir, "documents").select(
        "doc_id", plain.alias("plain"), crypto.encrypt(plain, key, place).alias("sealed")
    )
    opened = crypto.decrypt("sealed", key, place)
    misplaced = crypto.decrypt("sealed", key, F.concat(place, F.lit("x")))
    return sealed.select(
        "doc_id",
        F.md5(opened).alias("md5"),
        F.length("sealed").cast("bigint").alias("sealed_size"),
        (F.col("sealed") != F.col("plain")).alias("differs"),
        F.when(misplaced.isNull(), "failed").otherwise("copied").alias("misplaced_status"),
    )


# --- joins ---------------------------------------------------------------------


@query(f"""
with {FILES_SQL},
source as (
  select relpath || case lang when 'de' then '.pgp' else '' end as relpath, md5 from files
),
target as (
  select relpath || case lang when 'de' then '.pgp' else '' end as relpath,
         case lang when 'es' then md5(md5) when 'de' then null else md5 end as md5
  from files where lang <> 'fr'
  union all select 'extra/' || item_id, md5(text) from benchmark
)
select coalesce(s.relpath, t.relpath) as relpath, s.md5 as md5_source, t.md5 as md5_target,
       case when t.relpath is null then 'missing' when s.relpath is null then 'unexpected'
            when s.md5 = t.md5 then 'verified'
            when (s.md5 is null or t.md5 is null) and ends_with(s.relpath, '.pgp') then 'exempt'
            else 'mismatch' end as "check"
from source s full join target t on s.relpath = t.relpath
""")
def verify_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides by path: French files did not arrive, Spanish ones changed, German ones are sealed."""
    name = F.concat("relpath", F.when(F.col("lang") == "de", ".pgp").otherwise(""))
    files = document_files(spark, sf_dir)
    stored_md5 = F.when(F.col("lang") == "es", F.md5("md5")).when(F.col("lang") != "de", F.col("md5"))
    extra = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("extra/"), "item_id").alias("relpath"), F.md5("text").alias("md5")
    )
    source = files.select(name.alias("relpath"), "md5")
    target = files.where("lang <> 'fr'").select(name.alias("relpath"), stored_md5.alias("md5")).unionByName(extra)
    return verify(source, target)


@query("""
with stored as (select user_id, count(*) as n, max(event_id) as event_id from events group by 1)
select c_custkey, s.event_id is not null as found, s.event_id as stored_event_id,
       (select max_by(e.event_type, e.event_id) from events e where e.user_id = c.c_custkey) as stored_event_type
from customer c left join stored s on s.user_id = c.c_custkey
""")
def object_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row once, with the newest of what is stored under its key, or nothing."""
    stored = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"), "event_id", "event_type")
    return lookup_objects(table(spark, sf_dir, "customer").select("c_custkey"), stored, ["c_custkey"])


@query(f"""
with {FILES_SQL}
select relpath, mtime_s from files f where not exists (select 1 from labels l where l.doc_id = f.doc_id)
""")
def not_yet_transferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger does not hold; here the labelled documents have been sent."""
    done = table(spark, sf_dir, "labels").select("doc_id")
    return ledger.exclude_transferred(document_files(spark, sf_dir), done, ["doc_id"]).select("relpath", "mtime_s")


@query(f"""
with {LEDGER_SQL}
select relpath, mtime_s, max(origin) as origin from (
  select relpath, mtime_s, 'window' as origin from files where {in_window_sql('mtime_s')}
  union all select relpath, mtime_s, 'retry' from ledger where "check" in ('failed', 'mismatch')
) group by all
""")
def retry_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new window and earlier failures, each file once."""
    window = document_files(spark, sf_dir, (FROM_S, TO_S))
    failed = ledger.unsent(document_ledger(spark, sf_dir))
    return ledger.retry_set(
        window.select("relpath", "mtime_s", F.lit("window").alias("origin")),
        failed.select("relpath", "mtime_s", F.lit("retry").alias("origin")),
    )


_LATEST_SQL = """
select relpath, mtime_s, event_id, value from (
  select event_type || '/' || user_id as relpath, floor(epoch(ts))::bigint as mtime_s, event_id, value,
         row_number() over (partition by event_type, user_id order by floor(epoch(ts)) desc, event_id desc) as rn
  from events
) where rn = 1
"""


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("/"), "user_id").alias("relpath"),
        F.unix_seconds(instant("ts")).alias("mtime_s"),
        "event_id",
        "value",
    )


@query(_LATEST_SQL)
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of each path."""
    return ledger.latest_version(_versions(spark, sf_dir))


@query(_LATEST_SQL)
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a snapshot of earlier versions and ten runs since, half of them merged into a second snapshot."""
    versions, uri = _versions(spark, sf_dir).withColumn("_run", F.pmod("event_id", F.lit(20))), new_folder(spark, "snapshot")
    runs = lambda low, high: versions.where(f"_run >= {low} and _run < {high}").drop("_run")
    write_snapshot(ledger.latest_version(runs(10, 20)), uri, buckets=8)
    write_snapshot(with_runs(spark, uri, runs(0, 5)), uri, buckets=8)
    return with_runs(spark, uri, runs(5, 10))


# --- metrics ------------------------------------------------------------------------


@query(f"""
with {LEDGER_SQL}
select run_id, source, count(*) as total_uploaded_files from ledger where "check" in ('verified', 'exempt') group by all
""")
def uploaded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.uploaded_files(document_ledger(spark, sf_dir), ["run_id", "source"])


def _gauges_sql() -> str:
    values = {
        "created_on": "mtime_s",
        "size_bytes": "bytes",
        "seen_on": f"{LOGICAL_START_MS} // 1000",
        "transferred_on": "end_ms // 1000",
        "transfer_retries": "attempts - 1",
        "transfer_time": "end_ms - start_ms",
        "total_uploaded_files": "1",
    }
    return " union all ".join(
        f"""select pipeline, run_id, fullfilename as file, '{name}' as metric, ({value})::bigint as value,
        pipeline || '|' || run_id || '|' || fullfilename || '|{name}' as key
        from ledger where "check" = 'verified'"""
        for name, value in values.items()
    )


@query(f"with {LEDGER_SQL} {_gauges_sql()}")
def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven values per file sent, with their key."""
    return metrics.metrics_long(document_ledger(spark, sf_dir), LOGICAL_START_MS, with_key=True)


@query(f"""
with {LEDGER_SQL}
select source, lang, (grouping(source) * 2 + grouping(lang))::int as level, count(*) as files,
       sum(bytes)::bigint as bytes, sum(attempts - 1)::bigint as retries, max(attempts - 1)::bigint as max_retries,
       sum(end_ms - start_ms)::bigint as total_ms, max(end_ms - start_ms)::bigint as max_ms
from ledger group by rollup(source, lang)
""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.run_totals(document_ledger(spark, sf_dir), ["source", "lang"])


@query(f"""
with {LEDGER_SQL}
select lang, round(quantile_cont((end_ms - start_ms)::double, 0.5), 3) as half_ms,
       round(quantile_cont((end_ms - start_ms)::double, 0.95), 3) as most_ms, max(end_ms - start_ms)::double as all_ms
from ledger group by lang
""")
def transfer_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long half, most and all of the files took at most."""
    at = metrics.transfer_time_percentiles(document_ledger(spark, sf_dir), ["lang"], [0.5, 0.95, 1.0])
    return at.select("lang", *[F.round(F.col("ms_at")[n], 3).alias(name) for n, name in enumerate(("half_ms", "most_ms", "all_ms"))])


@query(f"""
with {FILES_SQL}
select source, count(*) as files, sum(size)::bigint as bytes, min('/' || relpath) as first_name,
       max('/' || relpath) as last_name
from files group by 1
""")
def listing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_files(spark, sf_dir).withColumn("filename", F.concat(F.lit("/"), "relpath"))
    return metrics.listing_summary(files, ["source"])


@query(f"with {FILES_SQL} select relpath as name, doc_id || '.txt' as leaf, size, mtime_s from files")
def listing_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.listing_messages(sftp_manifest(document_files(spark, sf_dir), "remote", "u", "h"))


@query(f"""
with {LEDGER_SQL}
select fullfilename as source, target, run_id,
       'fullfilename,relpath,mtime_s,path,target,check,pipeline,run_id' as columns
from ledger where "check" = 'verified'
""")
def field_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = ledger.lineage(document_ledger(spark, sf_dir))
    return lines.withColumn("columns", F.array_join("columns", ","))


@query(f"""
with {FILES_SQL}
select relpath, '/landing/' || relpath || '.pgp' as target, 'application/pgp-encrypted' as content_type,
       true as encrypted, 'encrypt' as action, size
from files
""")
def preview_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run: the plan of a sealed transfer, nothing moved."""
    manifest = sftp_manifest(document_files(spark, sf_dir), "remote", "u", "h")
    plan = plan_transfer(manifest, "/landing/", "encrypt")
    return plan.select("relpath", "target", "content_type", "encrypted", "action", "size")


@query("select count(*) as files, sum(strlen(text))::bigint as bytes from documents")
def discard_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan run for its effect alone; only what was observed on the way remains."""
    seen = Observation("seen")
    size = F.octet_length("text").cast("bigint")
    documents = table(spark, sf_dir, "documents").select(size.alias("size"), F.md5("text").alias("md5"))
    discard(documents.observe(seen, F.count("*").alias("files"), F.sum("size").alias("bytes")))
    return spark.createDataFrame([(seen.get["files"], seen.get["bytes"])], "files bigint, bytes bigint")
