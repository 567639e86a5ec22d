import gzip
import warnings

import pytest
from pyspark.sql import functions as F

from gleaner.operators import layout, prefix, stats
from gleaner.session import shared_dir
from gleaner.sources import files, warc
from gleaner.streaming.redact import redact_new_files


def record(url, body, kind="response", number=1):
    payload = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\n\r\n" + body
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{number}>\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


def test_warc_members_types_charsets_and_quoted_markers(spark, tmp_path):
    quoting = b"<p>A record starts with WARC/1.0\r\nand WARC/1.0\r\nagain</p>"
    parts = [
        record("u0", b"", kind="warcinfo", number=0),
        record("u1", quoting, number=1),
        record("u2", "é".encode("latin-1"), number=2),
        record("u3", "é😀".encode(), number=3),
        record("u4", b"x", kind="request", number=4),
    ]
    for name in ("a", "b"):
        (tmp_path / f"{name}.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    rows = warc.read_warc(spark, str(tmp_path)).orderBy("file_name", "warc_id").collect()
    assert [(r["file_name"], r["warc_id"], r["url"], r["content"]) for r in rows] == [
        (f"{n}.warc.gz", str(i), f"u{i}", c)
        for n in "ab"
        for i, c in ((1, quoting.decode()), (2, "é"), (3, "é😀"))
    ]


def members(n, cut=None):
    """``n`` records, number ``cut`` 30 bytes short, as single gzip members and as one plain file; pages quote records."""
    inner = record("quoted", b"x" * 40, number=999).decode("latin-1").encode()
    parts = []
    for i in range(n):
        body = f"<p>page {i}</p>".encode() + (b"\r\n\r\n" + inner + b"after" if i % 5 == 0 else b"") + b"y" * (i * 37 % 900)
        whole = record(f"u{i}", body, number=i)
        parts.append(whole[:-34] if i == cut else whole)
    return parts


@pytest.mark.parametrize("split", [700, 5_000, 1 << 20])
@pytest.mark.parametrize("zipped", [True, False])
def test_ranges_of_one_warc_file(spark, tmp_path, zipped, split):
    """Each record comes once, in whole, whatever the ranges; a record cut short loses only itself."""
    parts = members(60, cut=33)
    data = b"".join(map(gzip.compress, parts)) if zipped else b"".join(parts)
    (tmp_path / ("a.warc.gz" if zipped else "a.warc")).write_bytes(data)
    df = warc.read_warc(spark, str(tmp_path), split_bytes=split)
    if split == 700:
        assert df.rdd.getNumPartitions() > 10
    rows = df.orderBy("record_offset").collect()
    assert [r.warc_id for r in rows] == [str(i) for i in range(60) if i != 33]
    want = {str(i): p.split(b"\r\n\r\n", 2)[2].removesuffix(b"\r\n\r\n") for i, p in enumerate(parts)}
    assert all(r.content.encode() == want[r.warc_id] for r in rows)


def test_broken_gzip_member_loses_only_itself(spark, tmp_path):
    zipped = [gzip.compress(p) for p in members(20)]
    zipped[7] = zipped[7][:-40]
    zipped[12] = zipped[12][:20] + bytes(len(zipped[12]) - 20)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(zipped))
    for split in (300, 1 << 20):
        got = {int(r.warc_id) for r in warc.read_warc(spark, str(tmp_path), split_bytes=split).select("warc_id").collect()}
        assert set(range(20)) - {7, 12} <= got


@pytest.mark.parametrize("zipped", [True, False])
def test_limit_leaves_the_file(spark, tmp_path, zipped, monkeypatch):
    """Behind the first records lies what can't be read at all: a limit never gets there."""
    parts = members(30)
    data = b"".join(gzip.compress(p) if zipped else p for p in parts)
    (tmp_path / ("a.warc.gz" if zipped else "a.warc")).write_bytes(data)
    assert sorted(int(r.warc_id) for r in warc.read_warc(spark, str(tmp_path), limit=4).collect()) == [0, 1, 2, 3]

    class Counting:
        def __init__(self, data):
            self.data, self.at, self.read_bytes = data, 0, 0

        def seek(self, at):
            self.at = at

        def read(self, n):
            out = self.data[self.at : self.at + n]
            self.at += len(out)
            self.read_bytes += len(out)
            return out

    monkeypatch.setattr(warc, "_READ", 1000)
    monkeypatch.setattr(warc, "_LONGEST_HEADER", 1000)
    file = Counting(data * 50)
    read = (warc._gzip_records if zipped else warc._plain_records)(file, 0, len(file.data))
    assert len([next(read) for _ in range(4)]) == 4
    assert file.read_bytes < len(file.data) / 10


def test_files_only_spark_can_reach(spark, tmp_path, monkeypatch):
    """Spark's text reader gives the same rows, also where it splits plain files."""

    def unknown(path):
        raise OSError("no such scheme")

    parts = members(60, cut=33)
    (tmp_path / "a.warc").write_bytes(b"".join(parts))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    direct = sorted(r[:5] for r in warc.read_warc(spark, str(tmp_path)).collect())
    monkeypatch.setattr(warc, "_file_system", unknown)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        streamed = warc.read_warc(spark, str(tmp_path))
        assert sorted(r[:5] for r in streamed.collect()) == direct and len(direct) == 118
        assert warc.read_warc(spark, str(tmp_path), limit=2).count() == 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_listing_picks_main_files_in_order(spark, tmp_path):
    for name in ("s1/warc/b.warc.gz", "s1/warc/a.warc.gz", "s1/wet/c.warc.wet.gz", "s1/robotstxt/d.warc.gz"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    rows = files.list_input_files(spark, str(tmp_path)).collect()
    assert [(r["path"].rsplit("/", 1)[1], r["length"]) for r in rows] == [("a.warc.gz", 5), ("b.warc.gz", 5)]
    assert files.list_input_files(spark, str(tmp_path), limit=1).count() == 1


def test_missing_buckets(spark, tmp_path):
    df = spark.createDataFrame([(1, 18), (2, 3)], f"id bigint, `{files.BUCKET_COLUMN}` int")
    files.write_bucketed(df, str(tmp_path / "b"))
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        assert files.read_buckets(spark, str(tmp_path / "b")).count() == 1
    assert any("19" in str(w.message) for w in caught)
    with pytest.raises(FileNotFoundError):
        files.read_buckets(spark, str(tmp_path / "b"), [7])


def test_bucket_read_prunes_folders(spark, tmp_path):
    df = spark.range(40).withColumn(files.BUCKET_COLUMN, (F.col("id") % 20).cast("int"))
    files.write_bucketed(df, str(tmp_path / "b"))
    plan = files.read_buckets(spark, str(tmp_path / "b"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [ensemble" in plan


def test_empty_paths_list_reads_nothing(spark, tmp_path):
    (tmp_path / "list").write_text("\n \n")
    schema = spark.createDataFrame([], "a bigint").schema
    assert files.read_paths_list(spark, str(tmp_path), str(tmp_path / "list"), schema).count() == 0


@pytest.mark.parametrize("partitions", [1, 6])
def test_running_totals(spark, partitions):
    rows = [("a" if i % 4 else "b", i, (i * 37) % 11) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, i bigint, v bigint").repartition(partitions)
    total, by, got = 0, {"a": 0, "b": 0}, {}
    for g, i, v in rows:
        got[i] = (total, by[g] + v)
        total, by[g] = total + v, by[g] + v
    before = {r["i"]: r["t"] for r in prefix.running_total(df, F.col("v"), ["i"], "t", inclusive=False).collect()}
    within = {r["i"]: r["t"] for r in prefix.running_total(df, F.col("v"), ["i"], "t", within=["g"]).collect()}
    assert {i: (before[i], within[i]) for i in before} == got


def test_running_totals_of_odd_tables(spark):
    nan = float("nan")
    rows = [(g, i, None if i % 5 == 0 else i + 0.5, i) for i in range(60) for g in (None, nan, -1.5, 2.0)]
    df = spark.createDataFrame(rows, "g double, i int, v double, _value0 int").repartition(7)
    sums = {"t": F.col("v"), "d": F.col("i").cast("decimal(10,2)"), "_value0": F.lit(1)}
    got = prefix.running_totals(df, sums, ["i"], within=["g"]).collect()
    assert len(got) == len(rows)
    for r in got:
        told = [i for i in range(r["i"] + 1)]
        assert r["t"] == sum(i + 0.5 for i in told if i % 5) and r["d"] == sum(told) and r["_value0"] == len(told)
    empty = prefix.running_totals(df.limit(0), {"t": F.col("v")}, ["i"], within=["g"])
    assert empty.columns == ["g", "i", "v", "_value0", "t"] and empty.count() == 0
    again = df.select("i").repartition(5)
    numbered = sorted((r["i"], r["n"]) for r in prefix.row_index(again, ["i"], "n").collect())
    assert [n for _, n in numbered] == list(range(len(rows))) and [i for i, _ in numbered] == sorted(i for _, i, _, _ in rows)


def test_running_totals_move_rows_once(spark, monkeypatch):
    df = spark.range(0, 1000, numPartitions=4).withColumn("g", F.col("id") % 3)
    seen = []
    plain = prefix.store
    monkeypatch.setattr(prefix, "store", lambda rows, name: seen.append(rows) or plain(rows, name))
    out = prefix.running_total(df, F.col("id"), ["id"], "t", within=["g"])
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()


def test_parts_stay_within_the_limit_and_in_order(spark, tmp_path):
    sizes = [10, 20, 500, 30, 90, 100, 5, 5, 5, 95, 60, 60, 60, 1] * 5
    rows = [("f", i, "x" * n) for i, n in enumerate(sizes)] + [("g", 1000, "y")]
    df = spark.createDataFrame(rows, "file string, i bigint, text string").repartition(4)
    parts = layout.size_parts(df, 100, "file", ["i"], F.length("text").cast("bigint")).orderBy("file", "i").collect()
    numbers = [r["part"] for r in parts if r["file"] == "f"]
    assert numbers == sorted(numbers)
    totals = {}
    for r in parts:
        totals.setdefault((r["file"], r["part"]), []).append(r["row_bytes"])
    assert all(sum(v) <= 100 or len(v) == 1 for v in totals.values())
    layout.write_resharded(df, str(tmp_path / "out"), 4000, "file", ["i"])
    assert spark.read.json(str(tmp_path / "out")).count() == len(rows)


@pytest.mark.parametrize("shards", [3, 50])
def test_strides_share_out_all_files(spark, shards):
    table = spark.createDataFrame([(f"p{i:02d}", i) for i in range(10)], "path string, length bigint")
    names = [f"p{i:02d}" for i in range(10)]
    for k in (0, 2, min(shards - 1, 11)):
        got = sorted(r["path"] for r in layout.shard_stride(table, k, shards).collect())
        assert got == names[k::shards]
    with pytest.raises(ValueError):
        layout.shard_stride(table, shards, shards)


def test_record_limit_with_one_large_file(spark):
    rows = [("big", i) for i in range(500)] + [("small", i) for i in range(3)]
    df = spark.createDataFrame(rows, "file_name string, doc_id bigint").repartition(5)
    kept = sorted(map(tuple, layout.record_limit(df, 5, salts=4).collect()))
    assert kept == [("big", i) for i in range(5)] + [("small", i) for i in range(3)]


def test_empty_file_in_a_shard(spark):
    docs = spark.createDataFrame([("a", "xx\ny"), ("b", None), ("c", "")], "path string, text string")
    per_file = stats.file_char_stats(docs).withColumn("shard_id", F.when(F.col("path") == "b", 1).otherwise(0))
    rows = {r["shard_id"]: r.asDict() for r in stats.shard_char_stats(per_file).collect()}
    assert rows[1] == {"shard_id": 1, "n_files": 1, "n": 0, "mean": 0.0, "std": 0.0, "min": 0, "max": 0, "mean_lines": 0.0, "max_lines": 0}
    assert (rows[0]["mean"], rows[0]["std"], rows[0]["min"], rows[0]["max_lines"]) == (2.0, 2.0, 0, 1)


@pytest.mark.parametrize("size, text", [(0, "0.0 B"), (1023, "1023.0 B"), (1024, "1.0 KiB"), (1536, "1.5 KiB"), (565504, "552.2 KiB"), (5 * 1024**5 * 1024, "5120.0 PiB")])
def test_human_size(spark, size, text):
    assert spark.createDataFrame([(size,)], "s bigint").select(stats.human_size(F.col("s"))).first()[0] == text


def test_stream_redacts_new_files_once(spark, tmp_path):
    source = tmp_path / "in"
    docs = spark.createDataFrame([(1, "mail a@b.org"), (2, "plain")], "id bigint, text string")
    docs.write.json(str(source))
    run = lambda: redact_new_files(spark, str(source), str(tmp_path / "out"), str(tmp_path / "ck"), docs.schema).awaitTermination()
    run()
    docs.withColumn("id", F.col("id") + 10).write.mode("append").json(str(source))
    run()
    rows = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("id", "text", "pii_count").collect()))
    assert rows == [(1, "mail [EMAIL]", 1), (2, "plain", 0), (11, "mail [EMAIL]", 1), (12, "plain", 0)]


def test_scratch_lies_in_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    used = shared_dir(spark)
    assert used == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_many_folders_are_listed_in_few_tasks(spark, tmp_path):
    """Sixty folders take a few tasks a core to list, not one each; the session's setting comes back."""
    name, sc = "spark.sql.sources.parallelPartitionDiscovery.parallelism", spark.sparkContext
    before = spark.conf.get(name)
    df = spark.createDataFrame([(i, "x" * 700, "a") for i in range(60)], "i long, t string, file string")
    layout.write_resharded(df, str(tmp_path / "out"), 4000, "file", ["i"])
    sc.setJobGroup("listing", "listing")
    parts = layout.written_parts(spark, str(tmp_path / "out"), "file", "i", "i long, t string, file string, part int", 4000)
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages) <= 2 * sc.defaultParallelism
    assert spark.conf.get(name) == before and parts.count() == 60


def test_parts_are_written_without_hadoop_for_each_file(spark, tmp_path):
    """Hadoop's local files start a process for each file and its checksum; the same rows are read as of Spark's own tree."""
    odd = ["a=b/c%d:e", "%3A", "née 😀", None, "_x"]
    rows = [(i, None if i % 4 == 0 else 'te"xt\r\n' * i, v, i % 3) for i, v in enumerate(odd * 4)]
    ours, sparks, nulls = (str(tmp_path / n) for n in ("ours", "sparks", "nulls"))

    def laid_out(rows):
        df = spark.createDataFrame(rows, "i long, t string, file string, part int")
        return df.repartition(3, "file", "part").sortWithinPartitions("file", "part", "i")

    df = laid_out(rows)
    files.write_json_folders(df, ours, ["file", "part"])
    df.write.partitionBy("file", "part").json(sparks)
    # These three share one folder, which Spark's writer refuses where one task has them.
    files.write_json_folders(laid_out([(i, "t", v, i // 9) for i, v in enumerate([None, "", files.NO_VALUE] * 6)]), nulls, ["file", "part"])
    assert spark.read.json(nulls).count() == 18
    names = [p.name for p in (tmp_path / "ours").rglob("*") if p.is_file()]
    assert "_SUCCESS" in names and not any(n.startswith(".") for n in names)
    read = lambda path: sorted(map(repr, spark.read.schema(df.schema).json(path).collect()))
    assert len(read(ours)) == len(rows) and read(ours) == read(sparks)
    for path in (ours, sparks):
        parts = layout.written_parts(spark, path, "file", "i", df.schema, 4000).collect()
        assert sum(p["rows"] for p in parts) == len(rows) and {p["file"] for p in parts} == {"a=b/c%d:e", "%3A", "née 😀", None, "_x"}
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_json_folders(df, ours, ["file", "part"])


def test_jsonl_parts_are_written_in_as_many_files_as_their_size_takes(spark, tmp_path):
    from gleaner.catalog import QUERIES

    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.expr("concat_ws(' ', transform(sequence(1, 60), i -> md5(cast(100 * id + i AS string))))").alias("text"))
    docs = docs.selectExpr("*", "'en' AS lang", "'a' AS source", "length(text) AS n_chars")
    docs.repartition(8).write.parquet(str(tmp_path / "documents.parquet"))

    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "20k")
    try:
        rows = QUERIES["read_jsonl"](spark, str(tmp_path))
        assert rows.count() == 400 and rows.select(F.input_file_name()).distinct().count() > 6
    finally:
        spark.conf.unset(name)
