"""Detector inputs that Spark derives from the given tables; FIXTURES.md describes them.

``conversations`` become packets of uploaded files, ``embeddings`` become 8 x 8 detector frames, and
``events`` become frames of 256 readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanforge.config import RAW_SCAN_NAME, Geometry
from scanforge.plans.joins import lookup_join
from scanforge.plans.tables import shared_dir
from scanforge.schema import PACKET_SCHEMA
from scanforge.sinks.tables import land_packets
from scanforge.sources.calibration import from_named_matrices

SMALL = Geometry(8, 8)
PACKET_COLUMNS = [c.split()[0] for c in PACKET_SCHEMA.split(", ")]
FRAMES_PER_CHUNK = 4
FRAMES_PER_SCAN = 25
COPY_DELAY = 1_000_003


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversation_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One acquisition per conversation, one raw chunk per turn, ten conversations per experiment.

    Some chunks come twice, one copy possibly damaged, some of these at the same time; some acquisitions declare a chunk more
    than they have; some operation files are missing.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    names = {
        "experiment": F.expr("concat('exp_', conv_id div 10)"),
        "subdir_str": F.expr("concat('scan_', conv_id, if(conv_id % 10 = 0, '_bkg', ''))"),
        "filename_append": F.lit(""),
    }
    copies = F.expr("explode(if((conv_id + turn) % 5 = 0, array(0, 1), array(0)))").alias("copy")
    damaged = F.expr("(conv_id + turn) % 10 = 0 and copy = 0 or (conv_id + turn) % 15 = 0 and copy = 1")
    raw = (
        lookup_join(turns, counts, ["conv_id"], salt=F.col("turn"))
        .select("*", copies)
        .select(
            *[c.alias(n) for n, c in names.items()],
            F.lit(RAW_SCAN_NAME).alias("filename"),
            (F.col("turn") + 1).alias("chunk_i"),
            F.expr("n + if(conv_id % 7 = 3, 1, 0)").alias("n_total_chunks"),
            F.unhex(F.sha2("text", 512)).alias("chunk_hash"),
            F.concat("text", F.when(damaged, "!").otherwise("")).cast("binary").alias("data"),
            F.expr(f"(turn * 7919 + conv_id * 104729) % 1000003 + copy * if(conv_id % 4 = 1, 0, {COPY_DELAY})").alias("arrival_order"),
        )
    )
    files = F.explode(
        F.array_compact(
            F.array(
                F.when(F.expr("conv_id % 13 <> 5"), F.concat("subdir_str", F.lit(".xml"))),
                F.when(F.expr("conv_id % 13 <> 5 and conv_id % 6 = 0"), F.concat("subdir_str", F.lit(".xml"))),
                F.when(F.expr("conv_id % 17 = 2"), F.concat("subdir_str", F.lit(".txt"))),
                F.concat(F.lit("even_"), "conv_id", F.lit(".tif")),
            )
        )
    )
    one, text = F.lit(1).cast("bigint"), F.lit("<x/>").cast("binary")
    others = counts.select("conv_id", *[c.alias(n) for n, c in names.items()]).select(
        *names,
        files.alias("filename"),
        one.alias("chunk_i"),
        one.alias("n_total_chunks"),
        F.unhex(F.sha2(text, 512)).alias("chunk_hash"),
        text.alias("data"),
        F.lit(0).cast("bigint").alias("arrival_order"),
    )
    return raw.unionByName(others).select(*PACKET_COLUMNS)


CONVERSATION_PACKETS_SQL = f"""
conv as (select conv_id, turn, coalesce(text, '') as text, n,
    concat('exp_', conv_id // 10) as experiment,
    concat('scan_', conv_id, case when conv_id % 10 = 0 then '_bkg' else '' end) as subdir_str
  from conversations join (select conv_id, count(*) as n from conversations group by conv_id) using (conv_id)),
raw as (select *, unnest(case when (conv_id + turn) % 5 = 0 then [0, 1] else [0] end) as copy
  from conv),
packets as (
  select experiment, subdir_str, '{RAW_SCAN_NAME}' as filename, turn + 1 as chunk_i,
    n + case when conv_id % 7 = 3 then 1 else 0 end as n_total_chunks,
    (turn * 7919 + conv_id * 104729) % 1000003 + copy * case when conv_id % 4 = 1 then 0 else {COPY_DELAY} end as arrival_order,
    not ((conv_id + turn) % 10 = 0 and copy = 0 or (conv_id + turn) % 15 = 0 and copy = 1) as hash_ok,
    case when hash_ok then text else concat(text, '!') end as data
  from raw
  union all
  select * from (select experiment, subdir_str, unnest([
      case when conv_id % 13 <> 5 then concat(subdir_str, '.xml') end,
      case when conv_id % 13 <> 5 and conv_id % 6 = 0 then concat(subdir_str, '.xml') end,
      case when conv_id % 17 = 2 then concat(subdir_str, '.txt') end,
      concat('even_', conv_id, '.tif')]) as filename, 1, 1, 0, true, '<x/>'
    from (select distinct conv_id, experiment, subdir_str from conv)) where filename is not null),
operations as (select distinct subdir_str, filename as opr_filename from packets
  where substr(filename, 1, length(filename) - 4) = subdir_str and filename <> '{RAW_SCAN_NAME}'),
best as (select experiment, subdir_str, filename, chunk_i, max(n_total_chunks) as n_total_chunks, count(*) as n_copies,
    min(arrival_order) as first_arrival,
    arg_max(data, {{'ok': hash_ok, 'at': arrival_order, 'size': octet_length(encode(data)), 'text': data}}) as data, arg_max(hash_ok, {{'ok': hash_ok, 'at': arrival_order, 'size': octet_length(encode(data)), 'text': data}}) as hash_ok
  from packets group by all),
facts as (select experiment, subdir_str, case when contains(subdir_str, 'bkg') then 'noise' else 'signal' end as kind,
    cast(sum(n_copies) as bigint) as n_received, count(*) as n_chunks, max(n_total_chunks) as n_total_chunks,
    count(*) = max(n_total_chunks) as complete, min(first_arrival) as first_arrival
  from best where filename = '{RAW_SCAN_NAME}' and subdir_str in (select subdir_str from operations) group by all),
active as (select experiment, arg_min(subdir_str, first_arrival) as noise_subdir, arg_min(complete, first_arrival) as usable
  from facts where kind = 'noise' group by all)
"""


def _names() -> list[Column]:
    """Names of a scan of the given block: 25 frames a scan, 5 scans an experiment, the first its noise."""
    return [
        F.expr("concat('exp_', block div 5)").alias("experiment"),
        F.expr("concat('scan_', block, if(block % 5 = 0, '_bkg', ''))").alias("subdir_str"),
    ]


def _scan_columns(frames: DataFrame) -> DataFrame:
    return (
        frames.withColumn("block", F.expr(f"vec_id div {FRAMES_PER_SCAN}"))
        .withColumn("frame_no", F.expr(f"vec_id % {FRAMES_PER_SCAN}"))
        .withColumn("parity", F.expr("cast(frame_no % 2 as int)"))
        .select("*", *_names())
    )


# One detector word: analog count near 1000 plus a shift per signal frame, digital count 0 to 3, and the
# high-gain state on every third pixel.
_WORD = """1000 + pos + cast(floor(abs(cast(coalesce(x, 0) as double)) * 1000e0) as bigint) % 5
  + case when block % 5 = 0 then 0 else (vec_id % 43 - 21) * 10 end
  + ((vec_id * 64 + pos) % 2147483648 * 2654435761 % 4294967296 {div} 41) % 4 * 16384
  + case when pos % 3 = 0 then 2147483648 else 0 end"""


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _scan_columns(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return vectors.select("*", F.posexplode("embedding").alias("pos", "x")).drop("embedding")


def embedding_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form: one row per detector word."""
    return _points(spark, sf_dir).select(
        "experiment", "subdir_str", "frame_no", "parity", "pos", F.expr(_WORD.format(div="div")).alias("w")
    )


def embedding_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same words as packets of four frames, little-endian, with operation files.

    Every fourth scan gets a damaged copy of one chunk ahead of the good one, so that not all scans
    take the plain path. Every tenth scan has no operation file.
    """
    words = _points(spark, sf_dir).withColumn("h", F.expr(f"lpad(hex({_WORD.format(div='div')}), 8, '0')"))
    swapped = F.expr("concat(substring(h, 7, 2), substring(h, 5, 2), substring(h, 3, 2), substring(h, 1, 2))")
    place = F.expr(f"cast(frame_no * {SMALL.pixels} + pos as int)").alias("place")
    # One entry per word of a chunk, so at most 4 frames of 64 words.
    ordered = F.array_sort(F.collect_list(F.struct(place, swapped.alias("bytes"))))
    chunks = (
        words.groupBy("block", F.expr(f"frame_no div {FRAMES_PER_CHUNK} + 1").alias("chunk_i"))
        .agg(F.unhex(F.array_join(ordered["bytes"], "")).alias("good"))
        .select("*", *_names())
        .withColumn("copy", F.expr("explode(if(block % 4 = 1 and chunk_i = 3, array(0, 1), array(1)))"))
    )
    n_chunks = -(-FRAMES_PER_SCAN // FRAMES_PER_CHUNK)
    damaged = F.expr("unhex(repeat('00', octet_length(good)))")
    raw = chunks.select(
        "experiment",
        "subdir_str",
        F.lit(RAW_SCAN_NAME).alias("filename"),
        F.lit("").alias("filename_append"),
        "chunk_i",
        F.lit(n_chunks).cast("bigint").alias("n_total_chunks"),
        F.unhex(F.sha2("good", 512)).alias("chunk_hash"),
        F.when(F.col("copy") == 1, F.col("good")).otherwise(damaged).alias("data"),
        F.expr(f"(block * {n_chunks} + chunk_i) * 2 + copy").alias("arrival_order"),
    )
    one, text = F.lit(1).cast("bigint"), F.lit("<x/>").cast("binary")
    operations = (
        table(spark, sf_dir, "embeddings")
        .select(F.expr(f"vec_id div {FRAMES_PER_SCAN}").alias("block"))
        .filter("block % 10 <> 7")
        .distinct()
        .select(*_names())
        .select(
            "experiment",
            "subdir_str",
            F.concat("subdir_str", F.lit(".xml")).alias("filename"),
            F.lit("").alias("filename_append"),
            one.alias("chunk_i"),
            one.alias("n_total_chunks"),
            F.unhex(F.sha2(text, 512)).alias("chunk_hash"),
            text.alias("data"),
            F.lit(0).cast("bigint").alias("arrival_order"),
        )
    )
    return raw.unionByName(operations).select(*PACKET_COLUMNS)


def landed_embedding_packets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Packets written to the shared folder as a landed table, and that folder."""
    folder = shared_dir(spark)
    return land_packets(embedding_packets(spark, sf_dir), f"{folder}/packets"), folder


def small_calibration(spark: SparkSession) -> DataFrame:
    """Calibration of the 8 x 8 sensor, given as named matrices; all values are exact in binary."""
    places = spark.range(2 * SMALL.pixels).selectExpr("id % 2 as parity", "cast(id div 2 as int) as pos")
    entries = places.selectExpr(
        "pos div 8 as y",
        "pos % 8 as x",
        "stack(4,"
        " if(parity = 0, 'g1A', 'g1B'), 1.5e0 + parity * 0.25e0 + (pos % 8) * 0.125e0,"
        " if(parity = 0, 'g2A', 'g2B'), 0.25e0 + parity * 0.125e0,"
        " if(parity = 0, 'offA', 'offB'), 100.25e0 + parity,"
        " if(parity = 0, 'flatfA', 'flatfB'), 1e0 + (pos % 4) * 0.125e0) as (name, value)",
    )
    return from_named_matrices(entries, SMALL)


WORDS_SQL = f"""
vectors as (select vec_id, unnest(range(64)) as pos, embedding[pos + 1] as x, vec_id // {FRAMES_PER_SCAN} as block from embeddings),
words as (select concat('exp_', block // 5) as experiment,
    concat('scan_', block, case when block % 5 = 0 then '_bkg' else '' end) as subdir_str, block,
    vec_id % {FRAMES_PER_SCAN} as frame_no, cast(frame_no % 2 as int) as parity, cast(pos as int) as pos,
    {_WORD.format(div="//")} as w
  from vectors),
masks as (select parity, pos, 1.5e0 + parity * 0.25e0 + (pos % 8) * 0.125e0 as g1, 0.25e0 + parity * 0.125e0 as g2,
    100.25e0 + parity as off, 1e0 + (pos % 4) * 0.125e0 as flat
  from (select unnest([0, 1]) as parity), (select unnest(range(64)) as pos)),
scans as (select experiment, subdir_str, count(distinct frame_no) as n_frames from words group by all),
decoded as (select experiment, subdir_str, block, frame_no, parity, pos, flat,
    case when (w >> 31) & 1 = 1 then g1 * ((w & 16383) - off) else cast(w & 16383 as double) end
      + g2 * ((w >> 14) & 65535) as value
  from words join masks using (parity, pos)),
means as (select experiment, subdir_str as noise_subdir, parity, pos, avg(value) as mean
  from decoded join scans using (experiment, subdir_str)
  where block % 5 = 0 and frame_no < 2 * (n_frames // 2) group by all),
subtracted as (select d.experiment, d.subdir_str, d.block, d.frame_no, d.parity, d.pos, d.flat, d.value - m.mean as value
  from decoded d join means m using (experiment, parity, pos) where d.block % 5 <> 0)
"""


def offsets_sql(source: str, frame: str) -> str:
    """CTEs that end in ``offsets``: peak count, peak bin and offset for every frame of ``source``."""
    same = " and ".join(f"p.{c} = b.{c}" for c in frame.split(", "))
    return f"""
bins as (select {frame}, case when value >= -205 and value < 215 then least(cast(floor((value + 205) / 10) as bigint), 41) else -1 end as bin,
    count(*) as n from {source} group by all),
ranked as (select *, row_number() over (partition by {frame} order by case when bin < 0 then 0 else n end desc, bin) as k from bins),
peaks as (select {frame}, case when bin < 0 then 0 else bin end as am, case when bin < 0 then 0 else n end as mx,
    greatest(am - 3, 0) as i1, least(am + 4, 42) - greatest(am - 3, 0) as len from ranked where k = 1),
near as (select p.*, coalesce(n, 0) as n, coalesce(bin - i1 - 3, 0) as w from peaks p
  left join bins b on {same} and bin >= i1 and bin < i1 + len),
sums as (select {frame}, am, mx, cast(sum(n) as double) as sy, cast(sum(w * n) as double) as sxy, cast(sum(w * w * n) as double) as sx2y,
    case len when 4 then 14e0 when 5 then 15e0 when 6 then 19e0 else 28e0 end as x2,
    case len when 4 then 98e0 when 5 then 99e0 when 6 then 115e0 else 196e0 end as x4 from near group by {frame}, am, mx, len),
fits as (select *, sxy / x2 as bv, (7 * sx2y - x2 * sy) / (7 * x4 - x2 * x2) as av from sums),
centres as (select *, -205 + 10 * am + 5 + (case when abs(av) > 0.0001e0 then -bv / (2 * av) else 0e0 end) * 10 as o from fits),
offsets as (select {frame}, cast(mx as bigint) as hist_max, cast(am + 1 as int) as hist_arg,
    case when mx <= 40 or abs(o) > 200 then 0e0 else o end as "offset" from centres)
"""


READINGS_PER_FRAME = 256
READING_FRAMES = f"event_id {{div}} {READINGS_PER_FRAME}"


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """256 readings a frame, moved down frame by frame so that peaks reach and pass the lower border."""
    return (
        table(spark, sf_dir, "events")
        .select(F.expr(READING_FRAMES.format(div="div")).alias("frame"), "event_id", "value")
        .withColumn("value", F.expr("value - 7 * (frame % 60)"))
    )


READINGS_SQL = f"""
readings as (select {READING_FRAMES.format(div="//")} as frame, event_id, value - 7 * (frame % 60) as value from events)
"""
