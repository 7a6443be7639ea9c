"""Column functions on the odd cases."""

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import crypto
from tidemark.functions import paths as P
from tidemark.functions import times as T
from tidemark.operators import transfer
from tidemark.operators.filters import delta_filter, name_filter, regular_files, subtree_filter, without_secrets
from tidemark.sources.fs import split_uri
from tidemark.options import TransferOptions, regex_problem, safety_from_text, uri_problem


def values(spark, texts, *columns):
    rows = spark.createDataFrame([(at, text) for at, text in enumerate(texts)], "at int, t string")
    found = [tuple(row) for row in rows.orderBy("at").select(*columns).collect()]
    return [row[0] for row in found] if len(columns) == 1 else found


def test_parts_of_a_path(spark):
    texts = ["/in/sub/a.csv", "a.csv", "/a.csv", "/in/sub/", "a\nb/c", ""]
    assert values(spark, texts, P.directory("t")) == ["/in/sub/", "", "/", "/in/sub/", "a\nb/", ""]
    assert values(spark, texts, P.leaf("t")) == ["a.csv", "a.csv", "a.csv", "", "c", ""]
    assert values(spark, ["/in//sub/a.csv", "a"], P.folders("t")) == [["in", "sub"], []]


def test_object_uri(spark):
    texts = ["gs://b/n", "/b/n", "b/n", "gs://b", "gs://my_bucket/a b/c#ñ%.csv", "gs://Bad/x", "", "//b/n", "b//n"]
    parsed = values(spark, texts, P.parse_object_uri("t"))
    assert [(p.bucket, p.name, p.valid) for p in parsed] == [
        ("b", "n", True),
        ("b", "n", True),
        ("b", "n", True),
        ("b", "", True),
        ("my_bucket", "a b/c#ñ%.csv", True),
        ("Bad", "x", False),
        ("", "", False),
        ("/b/n", "", False),
        ("b", "/n", True),
    ]
    assert parsed[4].uri == "gs://my_bucket/a%20b/c%23%C3%B1%25.csv"


def test_bad_uri_raises_when_strict(spark):
    assert values(spark, ["gs://b/n"], P.parse_object_uri("t", strict=True))[0].bucket == "b"
    for bad in ("", "gs://Bad/x", None):
        with pytest.raises(PySparkException):
            values(spark, [bad], P.parse_object_uri("t", strict=True))


def test_roots_and_targets(spark):
    texts = ["gs://b/in", "gs://b", "/b/in/", "b/in", "file:///x"]
    assert values(spark, texts, P.normalise_root("t")) == ["/b/in/", "/b/", "/b/in/", "b/in/", "/x/"]
    filename = F.lit("/sub/a.csv")
    names = [P.target_object_name(folder, filename) for folder in ("/dir/", "dir", "/", "")]
    assert values(spark, ["x"], *names) == [("dir/sub/a.csv", "dir/sub/a.csv", "sub/a.csv", "sub/a.csv")]


def test_encrypted_suffix_needs_its_dot(spark):
    assert values(spark, ["a.pgp", "xpgp", "a.pgp.x"], P.is_encrypted("t")) == [True, False, False]
    assert values(spark, ["a.pgp", "xpgp", ".pgp"], P.strip_suffix("t")) == ["a", "xpgp", ""]


def test_property_map(spark):
    defaults = {"StrictHostKeyChecking": "no"}
    texts = [None, "", "a:1 , b:2", "a:1,a:2", "StrictHostKeyChecking:yes", "p:x:y", "flag"]
    assert values(spark, texts, P.property_map("t", defaults)) == [
        {"StrictHostKeyChecking": "no"},
        {"StrictHostKeyChecking": "no"},
        {"StrictHostKeyChecking": "no", "a": "1", "b": "2"},
        {"StrictHostKeyChecking": "no", "a": "2"},
        {"StrictHostKeyChecking": "yes"},
        {"StrictHostKeyChecking": "no", "p": "x:y"},
        {"StrictHostKeyChecking": "no", "flag": None},
    ]


def test_messages_and_blanks(spark):
    assert values(spark, ["/a", "//a", "a", ""], P.strip_leading_slash("t")) == ["a", "/a", "a", ""]
    assert values(spark, [None, "", " "], P.is_blank("t")) == [True, True, False]


def test_watermark_status(spark):
    texts = ["1629205254", "1629205254\n", "0", "20210715", "16292O5254", "4816407641", "", None]
    assert values(spark, texts, T.watermark_status("t", 1_700_000_000)) == [
        "ok", "ok", "bad_length", "bad_length", "not_numeric", "future", "bad_length", "bad_length",
    ]
    assert values(spark, texts[:2], T.watermark_status("t", 1_700_000_000, legacy=True)) == ["ok", "bad_length"]
    assert values(spark, ["1629205254"], T.watermark_status("t")) == ["ok"]


def test_safety_lag(spark):
    texts = ["25", None, "", "-1", "x", "0", "2.5", " 25"]
    assert values(spark, texts, T.safety_lag("t")) == [25, 300, 300, 300, 300, 0, 300, 300]
    assert [safety_from_text(text) for text in ("25", None, "-1", "x")] == [25, 300, 300, 300]


def test_window_bounds():
    assert T.window_bounds(1_704_240_300_999) == (0, 1_704_240_000)
    assert T.window_bounds(1_000_000, 0, from_delta=5, persisted=7) == (5, 1_000)
    assert T.window_bounds(1_000_000, 0, persisted=7) == (7, 1_000)
    assert T.window_bounds(1_000_000, 0, from_delta=0, persisted=7) == (0, 1_000)


def test_window_edges_at_fractions_of_a_second(spark):
    rows = spark.sql(
        "select timestamp_micros(id) as t, unix_seconds(timestamp_micros(id)) as s, id from values "
        "(100000000), (100500000), (101000000), (200999999), (201000000) as v(id)"
    )
    for on in ("t", "s"):
        kept = {row.id for row in delta_filter(rows, 100, 200, on=on).collect()}
        assert kept == {101_000_000, 200_999_999}
    naive = rows.withColumn("n", F.col("t").cast("timestamp_ntz"))
    assert delta_filter(naive, 100, 200, on="n").count() == 2


def test_window_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts")
    plan = delta_filter(events, 1_704_110_400, 1_704_240_000, on="ts")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,2024-01-01T12:00:01)" in plan
    assert "LessThan(ts,2024-01-03T00:00:01)" in plan


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=3, max_size=3), st.lists(st.integers(0, 50), max_size=30))
def test_windows_tile(spark, bounds, times):
    a, b, c = sorted(bounds)
    files = spark.createDataFrame([(t,) for t in times], "mtime_s bigint")
    parts = [sorted(r.mtime_s for r in delta_filter(files, *w).collect()) for w in ((a, b), (b, c), (a, c))]
    assert sorted(parts[0] + parts[1]) == parts[2]


def test_whole_names_only(spark):
    names = ["a.csv", "a.csv\n", "sub/a.csv", "xa.csv", "a.csv.bak", "b.csv"]
    files = spark.createDataFrame([(name,) for name in names], "relpath string")
    assert {r.relpath for r in name_filter(files, r"a\.csv|b\.csv").collect()} == {"a.csv", "sub/a.csv", "b.csv"}
    for no_pattern in ("", None):
        assert name_filter(files, no_pattern).count() == len(names)


def test_subtrees(spark):
    names = ["a", "src1/b", "src1/x/c", "src10/d", "src1/", ""]
    files = regular_files(spark.createDataFrame([(name,) for name in names], "relpath string"))

    def kept(*settings):
        return {r.relpath for r in subtree_filter(files, *settings).collect()}

    assert kept("") == {"a"}
    assert kept("", True) == {"a", "src1/b", "src1/x/c", "src10/d"}
    assert kept("src1") == {"src1/b"}
    assert kept("src1/", True) == {"src1/b", "src1/x/c"}


def test_key_stays_out_of_the_plan(spark, tmp_path):
    secret = b"0123456789abcdef"
    (tmp_path / "key").write_bytes(secret)
    key = crypto.key_from_uri(spark, str(tmp_path / "key"))
    sealed = spark.range(3).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("p"), "id").withColumn(
        "c", crypto.encrypt("p", key)
    )
    opened = sealed.select("id", crypto.decrypt("c", key, strict=True).cast("string").alias("t"))
    assert [r.t for r in opened.orderBy("id").collect()] == ["0", "1", "2"]
    plan = opened._jdf.queryExecution().toString()
    assert secret.decode() not in plan and secret.hex().upper() not in plan.upper()


def test_wrong_key_fails(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_bytes(name.encode() * 16)
    one, other = (crypto.key_from_uri(spark, str(tmp_path / name)) for name in ("a", "b"))
    sealed = spark.range(1).select(crypto.encrypt(F.lit(b"text"), one).alias("c"))
    assert sealed.select(crypto.decrypt("c", other)).first()[0] is None
    with pytest.raises(PySparkException):
        sealed.select(crypto.decrypt("c", other, strict=True)).collect()


def test_split_uris():
    assert split_uri("/a b/%20") == ("file", "", "/a b/%20")
    assert split_uri("file:///a") == split_uri("file:/a") == ("file", "", "/a")
    assert split_uri("s3a://bucket/a b") == ("s3", "bucket", "bucket/a b")
    assert split_uri("gs://bucket") == ("gs", "bucket", "bucket/")
    assert split_uri("hdfs://name:8020/a") == ("hdfs", "name:8020", "/a")


def test_good_uris():
    for uri in ("/in", "file:/in", "file:///in", "gs://my_bucket/a", "hdfs://name:8020/in", "hdfs:///in", None):
        assert uri_problem(uri) is None


@pytest.mark.parametrize(
    "change, words",
    [
        ({"pipeline": ""}, "pipeline is required"),
        ({"retries": 101}, "retries"),
        ({"wait_s": 301}, "wait_s"),
        ({"retries": -1}, "retries"),
        ({"regex": "("}, "regex"),
        ({"encryption": "aes_gcm"}, "key_uri"),
        ({"encryption": "PGP"}, "encryption is one of"),
        ({"archive": "rename"}, "archive_root"),
        ({"archive": "rename", "archive_root": "/in/"}, "differs"),
        ({"archive": "rename", "archive_root": "file:///in"}, "differs"),
        ({"archive": "yes"}, "archive is one of"),
        ({"source_root": "in"}, "source_root is neither"),
        ({"target_root": "gs://Bad/x"}, "target_root has no valid bucket"),
        ({"state_root": "state"}, "state_root is neither"),
        ({"direction": "up"}, "direction"),
        ({"safety_s": -1}, "safety_s"),
    ],
)
def test_bad_options(spark, change, words):
    good = {"pipeline": "p", "source_root": "/in", "target_root": "/out"}
    TransferOptions(**good).validate(spark)
    with pytest.raises(ValueError, match=words):
        TransferOptions(**{**good, **change}).validate(spark)


def test_a_pattern_has_to_stand_by_itself(spark):
    assert regex_problem(spark, "a)|(?:b") is not None
    assert regex_problem(spark, "a|b") is None


def test_container_of_an_account_heads_the_path():
    assert split_uri("abfss://box@account.example.net/a/b%20c")[2] == "box/a/b%20c"
    assert split_uri("gs://bucket/a")[2] == "bucket/a"


def test_credentials_do_not_travel(spark):
    """Nor does any column that nobody has named, whatever it is called."""
    names = ("sftpPass", "PrivateKeyPass", "privateKeyPassword", "serviceFilePath", "connection", "tokenOfTomorrow", "a.b", "RelPath", "md5_source")
    rows = spark.range(1).select("id", *[F.lit("x").alias(n) for n in names])
    assert without_secrets(rows).columns == ["RelPath", "md5_source"]
    assert without_secrets(rows, keep=("id", "a.b")).columns == ["id", "a.b", "RelPath", "md5_source"]


def test_only_a_source_that_is_gone_is_missing(tmp_path, monkeypatch):
    def taken_away(uri, buffer_bytes):
        raise FileNotFoundError(uri)

    (tmp_path / "a").write_bytes(b"x")
    rows = pd.DataFrame({"path": [f"{tmp_path}/a", f"{tmp_path}/gone"], "target": [f"{tmp_path}/b", f"{tmp_path}/c"], "content_type": ["t", "t"]})
    monkeypatch.setattr(transfer, "digest", taken_away)
    done = pd.concat(transfer._copier(1, 1 << 20, 1)(iter([rows])))
    assert list(zip(done["status"], done["attempts"])) == [("failed", 1), ("missing", 1)]
