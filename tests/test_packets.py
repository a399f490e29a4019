import hashlib
import struct

import pytest
from pyspark.errors import AnalysisException, PythonException
from pyspark.sql import functions as F

import golden
from scanforge.operators import integrity, select
from scanforge.schema import PACKET_SCHEMA
from scanforge.sources import packets as sources


def text(s):
    b = s.encode()
    return bytes([0xA0 + len(b)]) + b if len(b) < 32 else b"\xd9" + bytes([len(b)]) + b


def blob(b):
    return b"\xc4" + bytes([len(b)]) + b if len(b) < 256 else b"\xc5" + struct.pack(">H", len(b)) + b


def envelope(name, digest, chunk_i, total, subdir, append, data):
    numbers = [bytes([chunk_i]) if chunk_i < 128 else b"\xcd" + struct.pack(">H", chunk_i), b"\xce" + struct.pack(">I", total)]
    head = b"\x99"
    return head + text(name) + b"\xc0" + blob(digest) + b"\xcb" + struct.pack(">d", 1.5) + b"".join(numbers) + text(subdir) + append + blob(data)


def test_envelopes_become_packets(spark):
    data = bytes(range(256)) * 2
    good = envelope("a" * 40 + ".raw", hashlib.sha512(data).digest(), 300, 70000, "sub", text("x"), data)
    bad_hash = envelope("b.raw", b"\0" * 64, 7, 9, "süb", b"\xc0", b"zz")
    messages = spark.createDataFrame([(bytearray(good), 1), (bytearray(bad_hash), 2)], "value binary, arrival_order bigint")
    rows = integrity.check_integrity(sources.decode_packets(messages, "lab")).orderBy("arrival_order").collect()
    first, second = rows
    assert (first["filename"], first["chunk_i"], first["n_total_chunks"]) == ("a" * 40 + ".raw", 300, 70000)
    assert (first["subdir_str"], first["filename_append"], bytes(first["data"])) == ("sub", "x", data)
    assert first["hash_ok"] and first["n_bytes"] == 512 and first["experiment"] == "lab"
    assert not second["hash_ok"] and second["subdir_str"] == "süb" and second["filename_append"] is None


@pytest.mark.parametrize("message", [b"\x01", b"\x99\xa3ab", b"\x99" + b"\xc1" * 9, b"\x92\xc0\xc0"])
def test_broken_envelopes_fail_or_are_flagged(spark, message):
    messages = spark.createDataFrame([(bytearray(message),)], "value binary")
    with pytest.raises(PythonException):
        sources.decode_packets(messages, "lab").collect()
    row = sources.decode_packets(messages, "lab", on_error="flag").first()
    assert row["decode_error"] and row["filename"] is None


def test_topic_options():
    options = sources.topic_options("host:1", "scans", {"security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN"})
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "scans"
    assert options["kafka.security.protocol"] == "SASL_SSL" and options["kafka.sasl.mechanism"] == "PLAIN"


def test_topic_without_connector_is_an_error(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        sources.read_topic(spark, "host:1", "scans", streaming=False)


def test_message_order_follows_time(spark):
    rows = [("2024-01-01 00:00:00.001", 0, 5), ("2024-01-01 00:00:00.002", 0, 1), ("2026-01-01 00:00:00", 3, 0)]
    df = spark.createDataFrame(rows, "t string, partition int, offset bigint")
    df = df.withColumn("timestamp", F.col("t").cast("timestamp"))
    orders = [r["o"] for r in df.select("t", sources.message_order().alias("o")).orderBy("t").collect()]
    assert orders == sorted(orders) and 0 < orders[-1] < 2**122


def test_message_order_is_exact_within_a_millisecond(spark):
    rows = [(p, o) for p in (0, 1, 7) for o in range(1000)]
    df = spark.createDataFrame(rows, "partition int, offset bigint").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    ordered = df.orderBy(sources.message_order()).select("partition", "offset").collect()
    assert [tuple(r) for r in ordered] == rows and df.select(sources.message_order()).distinct().count() == len(rows)
    with pytest.raises(Exception, match="out of range"):
        df.withColumn("partition", F.lit(1 << 20)).select(sources.message_order()).collect()


def test_integrity_policies(spark):
    rows = [golden.packet("s", 1, 2, b"good", 1), golden.packet("s", 2, 2, b"bad", 2, digest=b"\1" * 64)]
    packets = spark.createDataFrame(rows, PACKET_SCHEMA)
    seen = {p: [r["chunk_i"] for r in integrity.check_integrity(packets, p).collect()] for p in integrity.POLICIES}
    assert sorted(seen["keep"]) == [1, 2] and seen["drop"] == [1] and seen["quarantine"] == [2]
    with pytest.raises(ValueError):
        integrity.check_integrity(packets, "other")


def test_valid_copy_wins_then_the_latest(spark):
    rows = [
        golden.packet("s", 1, 3, b"early", 1),
        golden.packet("s", 1, 3, b"late", 5),
        golden.packet("s", 2, 3, b"valid", 1),
        golden.packet("s", 2, 3, b"damaged", 9, digest=b"\1" * 64),
        golden.packet("s", 3, 3, b"bad1", 1, digest=b"\1" * 64),
        golden.packet("s", 3, 3, b"bad2", 2, digest=b"\1" * 64),
    ]
    packets = integrity.check_integrity(spark.createDataFrame(rows, PACKET_SCHEMA))
    best = {r["chunk_i"]: bytes(r["data"]) for r in integrity.latest_chunks(packets).collect()}
    assert best == {1: b"late", 2: b"valid", 3: b"bad2"}


def test_join_with_operation_files(spark):
    raw_named = golden.RAW[:-4]
    rows = [
        golden.packet("a", 1, 1, b"1", 1),
        golden.packet("a", 1, 1, b"1", 1, filename="a.xml"),
        golden.packet("a", 2, 2, b"2", 1, filename="a.xml"),
        golden.packet("b", 1, 1, b"3", 1),
        golden.packet("b", 1, 1, b"3", 1, filename="b.tar.gz"),
        golden.packet("c", 1, 1, b"4", 1),
        golden.packet("c", 1, 1, b"4", 1, filename="c.txt"),
        golden.packet("c", 1, 1, b"4", 1, filename="x"),
        golden.packet(raw_named, 1, 1, b"5", 1),
    ]
    packets = select.register_packets(spark.createDataFrame(rows, PACKET_SCHEMA), "incoming")
    joined = select.raw_operation_join(packets).collect()
    assert sorted((r["raw_subdir_str"], r["opr_filename"]) for r in joined) == [("a", "a.xml"), ("c", "c.txt")]
    statement = f"""select distinct raw.subdir_str, opr.filename from incoming raw, incoming opr
        where substr(opr.filename, 1, char_length(opr.filename) - 4) = opr.subdir_str
          and raw.filename = '{golden.RAW}' and opr.filename <> raw.filename and opr.subdir_str = raw.subdir_str"""
    assert sorted(map(tuple, spark.sql(statement).collect())) == [("a", "a.xml"), ("c", "c.txt")]


def test_marks(spark):
    rows = [("Scan_1_bkg", "ok.raw"), ("scan_1", "even_1.tif"), ("bkg_first", "x.log"), ("s", "a_stream_operations")]
    df = spark.createDataFrame(rows, "subdir_str string, filename string")
    out = df.select(select.kind().alias("k"), select.pairing_key().alias("p")).collect()
    assert [r["k"] for r in out] == ["noise", "signal", "noise", "signal"]
    assert [r["p"] for r in out] == ["scan_1", "scan_1", "bkg_first", "s"]
    assert [r["filename"] for r in select.exclude_ancillary(df).collect()] == ["ok.raw"]


def test_odd_envelopes_are_flagged(spark):
    def text(b):
        return bytes([0xDB]) + len(b).to_bytes(4, "big") + b

    def blob(b):
        return bytes([0xC6]) + len(b).to_bytes(4, "big") + b

    def envelope(skipped=b"\xc0", chunk=b"\x01", data=None):
        return b"\x99" + text(b"f") + skipped + blob(b"h") + b"\x93\x01\x02\x81\xa1a\x05" + chunk + text(b"12") + text(b"dir") + text(b"") + (data or blob(b"d"))

    good = [envelope(), envelope(b"\x92\x01\x81\xa1k\xc4\x01z"), envelope(b"\xc7\x03\x01abc"), envelope(chunk=text(b"7"))]
    bad = [envelope(chunk=text(b"x")), envelope(chunk=b"\xcb" + b"\x00" * 8), envelope(data=b"\x05"), b"", None, b"\x91\xa1a", b"\xff"]
    messages = spark.createDataFrame([(None if m is None else bytearray(m), i) for i, m in enumerate(good + bad)], "value binary, arrival_order bigint")
    rows = sources.decode_packets(messages, "lab", on_error="flag").orderBy("arrival_order").collect()
    assert [r["decode_error"] is None for r in rows] == [True] * len(good) + [False] * len(bad)
    assert [r["chunk_i"] for r in rows[: len(good)]] == [1, 1, 1, 7] and {r["n_total_chunks"] for r in rows[: len(good)]} == {12}
    with pytest.raises(Exception, match="empty"):
        sources.decode_packets(messages.filter("arrival_order = 7"), "lab").collect()
