"""Path algebra as Column expressions. Everything here stays inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.fixed import BUCKET_PATTERN, ENCRYPTED_SUFFIX, ENCRYPTED_TYPE, PLAIN_TYPE

ColumnOrName = Column | str

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:/+"
# Characters a URI fragment keeps as they are; url_encode escapes them.
_FRAGMENT_KEEPS = "~!$'(),;&=@:+/?"


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _text(value: ColumnOrName) -> Column:
    """A plain string stands for itself here, not for a column name."""
    return F.lit(value) if isinstance(value, str) else value


def leaf(path: ColumnOrName) -> Column:
    """Text after the last slash."""
    return F.substring_index(_col(path), "/", -1)


def directory(path: ColumnOrName) -> Column:
    """Directory part with its trailing slash; empty when there is none."""
    path = _col(path)
    return F.left(path, F.length(path) - F.length(leaf(path)))


def below_root(path: ColumnOrName, root: ColumnOrName) -> Column:
    """What follows the root, leading slash kept."""
    return F.substr(_col(path), F.length(_text(root)) + 1)


def relative_path(path: ColumnOrName, root: ColumnOrName) -> Column:
    """Path below the root without a leading slash; the root may end in one."""
    return F.ltrim(below_root(path, F.rtrim(_text(root), F.lit("/"))), F.lit("/"))


def sftp_uri(user: ColumnOrName, host: ColumnOrName, port: ColumnOrName, root: ColumnOrName,
             filename: ColumnOrName) -> Column:
    """``sftp://user@host:port`` + root + filename; the first four are texts or columns."""
    return F.concat(F.lit("sftp://"), _text(user), F.lit("@"), _text(host), F.lit(":"), _text(port),
                    _text(root), _col(filename))


def store_full_name(bucket: ColumnOrName, name: ColumnOrName) -> Column:
    return F.concat(F.lit("/"), _col(bucket), F.lit("/"), _col(name))


def normalise_root(uri: ColumnOrName) -> Column:
    """Drop the scheme, keep one leading slash for it, end with a slash."""
    bare = F.regexp_replace(_col(uri), _SCHEME, "/")
    return F.when(bare.endswith("/"), bare).otherwise(F.concat(bare, F.lit("/")))


def valid_bucket(bucket: ColumnOrName) -> Column:
    return _col(bucket).rlike(rf"\A{BUCKET_PATTERN}\z")


def escape_object_name(name: ColumnOrName) -> Column:
    """Percent-encode for a URI, leaving what a fragment may hold."""
    escaped = F.replace(F.url_encode(_col(name)), F.lit("+"), F.lit("%20"))
    for char in _FRAGMENT_KEEPS:
        escaped = F.replace(escaped, F.lit(f"%{ord(char):02X}"), F.lit(char))
    return escaped


def parse_object_uri(uri: ColumnOrName, strict: bool = False, scheme: str = "gs") -> Column:
    """``scheme://b/n``, ``/b/n`` or ``b/n`` to struct(bucket, name, uri, valid).

    An empty path or a bad bucket raises when ``strict``, else ``valid`` is false.
    """
    uri = _col(uri)
    rest = F.regexp_replace(uri, r"\A(?:/|[A-Za-z][A-Za-z0-9+.\-]*://)", "")
    slash = F.locate("/", rest)
    bucket = F.when(slash > 1, F.left(rest, slash - 1)).otherwise(rest)
    name = F.when(slash > 1, F.substr(rest, slash + 1)).otherwise("")
    valid = F.coalesce(valid_bucket(bucket), F.lit(False))
    if strict:
        problem = F.concat(F.lit("invalid bucket in path: "), F.coalesce(uri, F.lit("null")))
        bucket = F.when(valid, bucket).otherwise(F.raise_error(problem))
    full = F.concat(F.lit(f"{scheme}://"), bucket, F.lit("/"), escape_object_name(name))
    return F.struct(bucket.alias("bucket"), name.alias("name"), full.alias("uri"), valid.alias("valid"))


def is_bucket_root(name: ColumnOrName) -> Column:
    return _col(name) == ""


def target_object_name(target_dir: ColumnOrName, filename: ColumnOrName) -> Column:
    """Name in the store: the target folder, then the path below the source root.

    The bucket root gives no leading slash.
    """
    folder = F.nullif(F.btrim(_text(target_dir), F.lit("/")), F.lit(""))
    return F.concat_ws("/", folder, F.ltrim(_col(filename), F.lit("/")))


def target_relative_path(fullfilename: ColumnOrName, basename: ColumnOrName) -> Column:
    """Path at the remote folder: the full name from the listed root's closing slash on."""
    return F.substr(_col(fullfilename), F.length(_col(basename)))


def folders(path: ColumnOrName) -> Column:
    """The folders above the leaf, empty steps skipped."""
    return F.filter(F.split(directory(path), "/"), lambda step: step != "")


def archive_path(target: ColumnOrName, filename: ColumnOrName, flatten: bool = False) -> Column:
    """Where an original goes: sub-tree kept, or its leaf name only."""
    below = leaf(filename) if flatten else F.ltrim(_col(filename), F.lit("/"))
    return F.concat(F.rtrim(_text(target), F.lit("/")), F.lit("/"), below)


def is_encrypted(name: ColumnOrName, suffix: str = ENCRYPTED_SUFFIX) -> Column:
    """The dot is part of the suffix, so ``backup-pgp`` is a plain file."""
    return _col(name).endswith(suffix)


def add_suffix(name: ColumnOrName, suffix: str = ENCRYPTED_SUFFIX) -> Column:
    return F.concat(_col(name), F.lit(suffix))


def strip_suffix(name: ColumnOrName, suffix: str = ENCRYPTED_SUFFIX) -> Column:
    name = _col(name)
    return F.when(is_encrypted(name, suffix), F.left(name, F.length(name) - len(suffix))).otherwise(name)


def content_type(encrypted: Column) -> Column:
    return F.when(encrypted, F.lit(ENCRYPTED_TYPE)).otherwise(F.lit(PLAIN_TYPE))


def metric_key(pipeline: ColumnOrName, run_id: ColumnOrName, file: ColumnOrName, metric: ColumnOrName) -> Column:
    return F.concat_ws("|", _col(pipeline), _col(run_id), _col(file), _col(metric))


def strip_leading_slash(path: ColumnOrName) -> Column:
    """One slash only, for messages."""
    path = _col(path)
    return F.when(path.startswith("/"), F.substr(path, F.lit(2))).otherwise(path)


def is_blank(value: ColumnOrName) -> Column:
    return F.coalesce(_col(value), F.lit("")) == ""


def property_map(text: ColumnOrName, defaults: dict[str, str] | None = None) -> Column:
    """``k:v, k:v`` to a map on top of defaults; the last value of a key wins."""
    base = F.create_map(*[F.lit(part) for pair in (defaults or {}).items() for part in pair]).cast(
        "map<string,string>"
    )
    pairs = F.filter(F.split(F.coalesce(_col(text), F.lit("")), r"\s*,\s*"), lambda pair: pair != "")

    def put(known: Column, pair: Column) -> Column:
        key = F.substring_index(pair, ":", 1)
        value = F.nullif(F.substr(pair, F.length(key) + 2), F.lit(""))
        others = F.map_filter(known, lambda name, _: name != key)
        return F.map_concat(others, F.create_map(key, value))

    return F.aggregate(pairs, base, put)
