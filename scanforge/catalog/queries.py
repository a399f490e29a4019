"""Every registered query: a name, the Spark job, and the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanforge.catalog import inputs as I
from scanforge.operators import assemble, background, debounce, decode, flatfield, integrity, matrix, select
from scanforge.plans import correction
from scanforge.plans.run import Outputs, correct_packets
from scanforge.plans.tables import save, shared_dir
from scanforge.sinks.histogram_log import log_lines, log_table, read_log, write_log
from scanforge.sinks.raw import export_raw, raw_table
from scanforge.sinks.tables import store_noise_means
from scanforge.sources import calibration as cal
from scanforge.sources import packets as sources
from scanforge.sources.raw_files import cut_into_chunks, read_exported, read_listed
from scanforge.streaming import correction as streaming
from scanforge.streaming.join import raw_operation_stream_join

QUERIES = {}
ORACLE_SQL = {}

FRAME = ["experiment", "subdir_str", "frame_no"]


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Rounds by the arithmetic that the SQL also states; the engines' own functions differ on ties."""
    scale = float(10**digits)
    return df.withColumns({c: F.floor(F.col(c).cast("double") * scale + 0.5) / scale for c in columns})


# Packets from conversations


def _packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.check_integrity(I.conversation_packets(spark, sf_dir))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = _packets(spark, sf_dir)
    facts = assemble.acquisition_facts(assemble.chunk_facts(packets), frame_bytes=1)
    return assemble.with_operation_file(facts, packets)


PACKETS = "with " + I.CONVERSATION_PACKETS_SQL


@query(
    PACKETS
    + """select chunk_i as raw_chunk_i, n_total_chunks as raw_n_total_chunks, p.subdir_str as raw_subdir_str,
  filename as raw_filename, data as raw_data, opr_filename, o.subdir_str as opr_subdir_str, experiment as my_experiment
from packets p join operations o on o.subdir_str = p.subdir_str where filename = 'scan_x256_y256.raw'"""
)
def raw_operation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = select.raw_operation_join(I.conversation_packets(spark, sf_dir))
    return joined.withColumn("raw_data", F.col("raw_data").cast("string"))


@query(
    PACKETS
    + """select experiment, subdir_str, filename, chunk_i, arrival_order from packets
where filename not like '%even%' and filename not like '%odd%' and filename not like '%.tif%'
  and filename not like '%.log%' and filename not like '%stream\\_operations%' escape '\\'"""
)
def exclude_ancillary(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = select.exclude_ancillary(I.conversation_packets(spark, sf_dir))
    return packets.select("experiment", "subdir_str", "filename", "chunk_i", "arrival_order")


@query(
    PACKETS
    + """select distinct experiment, subdir_str, case when contains(subdir_str, 'bkg') then 'noise' else 'signal' end as kind,
  regexp_replace(lower(subdir_str), '_?bkg$', '') as pairing_key from packets"""
)
def classify_and_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    acquisitions = I.conversation_packets(spark, sf_dir).select("experiment", "subdir_str").distinct()
    return acquisitions.select("*", select.kind().alias("kind"), select.pairing_key().alias("pairing_key"))


@query(PACKETS + "select experiment, subdir_str, kind, n_received, n_chunks, n_total_chunks, complete from facts")
def chunk_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(spark, sf_dir).select(
        "experiment", "subdir_str", "kind", "n_received", "n_chunks", "n_total_chunks", "complete"
    )


@query(PACKETS + "select experiment, noise_subdir, false as stored, usable from active")
def active_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.active_noise(_facts(spark, sf_dir))


@query(
    PACKETS
    + """select experiment, subdir_str, noise_subdir, n_chunks from facts join active using (experiment)
where usable and complete and kind = 'signal' and subdir_str not in
  (select distinct subdir_str from packets where filename like '%.txt')"""
)
def ready_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acquisitions with a text file beside their scan stand for those processed before."""
    packets = _packets(spark, sf_dir)
    facts = save(_facts(spark, sf_dir), f"{shared_dir(spark)}/facts")
    processed = packets.filter(F.col("filename").endswith(".txt")).select("experiment", "subdir_str")
    ready = assemble.ready_signals(facts, assemble.active_noise(facts), processed)
    return ready.select("experiment", "subdir_str", "noise_subdir", "n_chunks")


@query(
    PACKETS
    + """select experiment, subdir_str, chunk_i, cast(octet_length(encode(data)) as bigint) as n_frames,
  cast(coalesce(sum(octet_length(encode(data))) over (partition by experiment, subdir_str order by chunk_i
    rows between unbounded preceding and 1 preceding), 0) as bigint) as frame_start
from best where filename = 'scan_x256_y256.raw'"""
)
def frame_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of irregular length: one byte stands for one frame."""
    return assemble.frame_offsets(assemble.chunk_facts(_packets(spark, sf_dir)), frame_bytes=1).drop("n_copies", "best")


@query(
    PACKETS
    + """select experiment, subdir_str, filename, chunk_i, arrival_order, hash_ok,
  cast(octet_length(encode(data)) as bigint) as n_bytes, sha256(data) as digest,
  to_base64(unhex(sha256(data))) as digest_base64 from packets"""
)
def integrity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packets(spark, sf_dir).select(
        "experiment",
        "subdir_str",
        "filename",
        "chunk_i",
        F.col("arrival_order").cast("bigint").alias("arrival_order"),
        "hash_ok",
        "n_bytes",
        F.sha2("data", 256).alias("digest"),
        F.base64(F.unhex(F.sha2("data", 256))).alias("digest_base64"),
    )


@query(
    PACKETS
    + """select experiment, subdir_str, filename, chunk_i, arrival_order, cast(octet_length(encode(data)) as bigint) as n_bytes
from packets where not hash_ok"""
)
def integrity_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = integrity.check_integrity(I.conversation_packets(spark, sf_dir), policy="quarantine")
    return refused.select("experiment", "subdir_str", "filename", "chunk_i", F.col("arrival_order").cast("bigint").alias("arrival_order"), "n_bytes")


@query(
    PACKETS
    + """select experiment, subdir_str, filename, chunk_i, arrival_order, cast(octet_length(encode(data)) as bigint) as n_bytes
from packets where not hash_ok"""
)
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream sets aside by its policy."""
    folder = shared_dir(spark)
    tables = streaming.Tables(f"{folder}/stream", partition_by=[])
    packets = _incoming(I.conversation_packets(spark, sf_dir), f"{folder}/incoming")
    streaming.start(packets, streaming.record_completed(tables), tables, once=True, policy="quarantine", emit=None).awaitTermination()
    return tables.quarantined(spark).select("experiment", "subdir_str", "filename", "chunk_i", F.col("arrival_order").cast("bigint").alias("arrival_order"), "n_bytes")


@query(PACKETS + "select experiment, subdir_str, filename, chunk_i, hash_ok, data from best")
def latest_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = integrity.latest_chunks(_packets(spark, sf_dir), ["hash_ok", "data"])
    return best.withColumn("data", F.col("data").cast("string"))


def _envelope(df: DataFrame) -> DataFrame:
    """Packs packet columns the way a producer sends them: nine fields, two of them never read."""

    def blob(c, head):
        return F.concat(F.unhex(F.concat(F.lit(head), F.lpad(F.hex(F.octet_length(c)), 8, "0"))), c)

    def text(c):
        return blob(F.col(c).cast("binary"), "DB")

    def number(c):
        return F.unhex(F.concat(F.lit("CF"), F.lpad(F.hex(F.col(c)), 16, "0")))

    nil = F.unhex(F.lit("C0"))
    fields = [text("filename"), nil, blob(F.col("chunk_hash"), "C6"), number("arrival_order")]
    fields += [number("chunk_i"), number("n_total_chunks"), text("subdir_str"), text("filename_append")]
    fields.append(blob(F.col("data"), "C6"))
    return df.select(F.concat(F.unhex(F.lit("99")), *fields).alias("value"), "arrival_order")


@query(
    PACKETS
    + """select 'lab' as experiment, subdir_str, filename, chunk_i, n_total_chunks, arrival_order, hash_ok, data from packets"""
)
def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _envelope(I.conversation_packets(spark, sf_dir))
    packets = integrity.check_integrity(sources.decode_packets(messages, "lab"))
    return packets.select(
        "experiment",
        "subdir_str",
        "filename",
        "chunk_i",
        "n_total_chunks",
        F.col("arrival_order").cast("bigint").alias("arrival_order"),
        "hash_ok",
        F.col("data").cast("string").alias("data"),
    )


@query(
    """with f as (select doc_id, hex(encode(text)) as h, octet_length(encode(text)) as size,
  greatest(octet_length(encode(text)) // 16, 1) as step from documents where text is not null),
c as (select *, greatest(cast(ceil(size / step) as bigint), 1) as n_total_chunks, unnest(range(greatest(cast(ceil(size / step) as bigint), 1))) + 1 as chunk_i from f)
select doc_id, chunk_i, n_total_chunks, cast(least(step, size - (chunk_i - 1) * step) as bigint) as n_bytes,
  md5(substr(h, (chunk_i - 1) * step * 2 + 1, step * 2)) as digest from c"""
)
def file_chunking(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = I.table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    return cut_into_chunks(files, n_chunks=16).select(
        "doc_id",
        "chunk_i",
        "n_total_chunks",
        F.octet_length("data").cast("bigint").alias("n_bytes"),
        F.md5(F.hex("data").cast("binary")).alias("digest"),
    )


def _incoming(packets: DataFrame, folder: str) -> DataFrame:
    """Packets written as files and read as a stream of about two micro-batches."""
    spark = packets.sparkSession
    packets.write.parquet(folder)
    n_files = len(spark.read.parquet(folder).inputFiles())
    return sources.stream_packet_files(spark, folder, files_per_trigger=max(1, (n_files + 1) // 2))


@query(
    PACKETS
    + "select experiment, subdir_str, n_chunks, n_total_chunks from facts where complete"
)
def stream_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark)
    tables = streaming.Tables(f"{folder}/stream", partition_by=[])
    packets = _incoming(I.conversation_packets(spark, sf_dir), f"{folder}/incoming")
    streaming.start(packets, streaming.record_completed(tables), tables, once=True).awaitTermination()
    return tables.completed(spark).select("experiment", "subdir_str", "n_chunks", "n_total_chunks")


@query(
    PACKETS
    + """select experiment, subdir_str, count(*) as n_packets, cast(sum(octet_length(encode(data))) as bigint) as n_bytes
from packets where filename = 'scan_x256_y256.raw' group by all"""
)
def packet_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets under a view's name, asked in SQL."""
    select.register_packets(I.conversation_packets(spark, sf_dir), "scan_packets")
    return spark.sql(
        "select experiment, subdir_str, count(*) as n_packets, cast(sum(octet_length(data)) as bigint) as n_bytes "
        "from scan_packets where filename = 'scan_x256_y256.raw' group by experiment, subdir_str"
    )


@query(
    PACKETS
    + """select distinct experiment, subdir_str from packets where filename = 'scan_x256_y256.raw'
  and experiment in (select experiment from packets where contains(subdir_str, 'bkg'))"""
)
def noise_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw scans of experiments that have a noise: projection, filter and a semi-join on names."""
    packets = I.conversation_packets(spark, sf_dir)
    noisy = packets.filter(select.kind() == "noise").select("experiment").distinct()
    return select.raw_scans(packets).join(noisy, "experiment", "left_semi").select("experiment", "subdir_str").distinct()


@query(PACKETS + "select experiment, subdir_str, filename, chunk_i, cast(octet_length(encode(data)) as bigint) as n_bytes from packets where hash_ok")
def integrity_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = integrity.check_integrity(I.conversation_packets(spark, sf_dir), policy="drop")
    return kept.select("experiment", "subdir_str", "filename", "chunk_i", "n_bytes")


@query(
    PACKETS
    + """select experiment, subdir_str, cast(count(*) filter (octet_length(encode(data)) % 7 <> 0) as bigint) as n_broken, count(*) as n_chunks,
  max(n_total_chunks) as n_total_chunks from best where filename = 'scan_x256_y256.raw' group by all having n_broken > 0"""
)
def malformed_acquisitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acquisitions with chunks that aren't whole frames, a frame being seven bytes."""
    facts = assemble.acquisition_facts(assemble.chunk_facts(_packets(spark, sf_dir)), frame_bytes=7)
    return assemble.malformed(facts)


@query(
    PACKETS
    + """select experiment, arg_min(subdir_str, first_arrival) as noise_subdir, false as stored, bool_or(complete) as usable
from facts where kind = 'noise' and subdir_str = 'scan_0_bkg' group by experiment"""
)
def explicit_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.active_noise(_facts(spark, sf_dir), noise_subdir="scan_0_bkg")


@query(
    PACKETS
    + """select experiment, subdir_str, noise_subdir from facts join active using (experiment)
where usable and complete and subdir_str <> noise_subdir"""
)
def extra_noise_as_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = save(_facts(spark, sf_dir), f"{shared_dir(spark)}/facts")
    ready = assemble.ready_signals(facts, assemble.active_noise(facts), treat_extra_noise_as_signal=True)
    return ready.select("experiment", "subdir_str", "noise_subdir")


@query(
    PACKETS
    + """select chunk_i as raw_chunk_i, p.subdir_str as raw_subdir_str, opr_filename, experiment as my_experiment
from packets p join operations o on o.subdir_str = p.subdir_str where filename = 'scan_x256_y256.raw'"""
)
def raw_operation_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join of raw chunks and operation files as a stream in micro-batches."""
    folder = shared_dir(spark)
    packets = _incoming(I.conversation_packets(spark, sf_dir), f"{folder}/incoming")
    joined = raw_operation_stream_join(packets).select("raw_chunk_i", "raw_subdir_str", "opr_filename", "my_experiment")
    writer = joined.writeStream.format("parquet").option("checkpointLocation", f"{folder}/check").trigger(availableNow=True)
    writer.start(f"{folder}/out").awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{folder}/out")


# Detector frames from embeddings

WORDS = "with " + I.WORDS_SQL
SUBTRACTED_OFFSETS = I.offsets_sql("subtracted", "experiment, subdir_str, frame_no")
CORRECTED = (
    WORDS
    + ","
    + SUBTRACTED_OFFSETS
    + """,
flattened as (select s.experiment, s.subdir_str, s.frame_no, s.parity, s.pos, s.block, o.hist_max, o.hist_arg, o."offset",
    cast((s.value - o."offset") * case when s.frame_no < 2 * (c.n_frames // 2) then s.flat else 1 end as float) as value
  from subtracted s join offsets o using (experiment, subdir_str, frame_no) join scans c using (experiment, subdir_str)),
whole as (select experiment, subdir_str from words where block % 10 <> 7 group by all having count(distinct frame_no // 4) = 7),
noises as (select distinct experiment from words join whole using (experiment, subdir_str) where block % 5 = 0),
corrected as (select f.* from flattened f join whole using (experiment, subdir_str) join noises using (experiment))
"""
)
CORRECTED_PIXELS = CORRECTED + (
    "select experiment, subdir_str, frame_no, pos, floor((cast(value as double)) * 1e4 + 0.5e0) / 1e4 as value from corrected"
)


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = cal.to_long(I.small_calibration(spark))
    return decode.decode_words(I.embedding_words(spark, sf_dir), masks)


def _scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = I.embedding_words(spark, sf_dir).filter("pos = 0")
    return words.groupBy("experiment", "subdir_str").agg(F.count_distinct("frame_no").alias("n_frames"))


def _noise_means(decoded: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    noise = decoded.filter(select.kind() == "noise")
    return background.noise_pixel_means(noise, _scans(spark, sf_dir))


def _subtracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = _decoded(spark, sf_dir)
    signal = decoded.filter(select.kind() == "signal")
    n_noises = _scans(spark, sf_dir).filter(select.kind() == "noise").count()
    means = _noise_means(decoded, spark, sf_dir)
    return background.subtract_background(signal, means, n_means=2 * I.SMALL.pixels * n_noises)


@query(WORDS + """select experiment, subdir_str, frame_no, parity, pos, w & 16383 as ana, (w >> 14) & 65535 as dig, (w >> 31) & 1 as gn from words""")
def word_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.word_fields(I.embedding_words(spark, sf_dir))


@query(WORDS + "select experiment, subdir_str, frame_no, parity, pos, floor(value * 1e6 + 0.5e0) / 1e6 as value from decoded")
def gain_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_decoded(spark, sf_dir), "value")


@query(WORDS + "select experiment, noise_subdir, parity, pos, floor(mean * 1e6 + 0.5e0) / 1e6 as mean from means")
def noise_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_noise_means(_decoded(spark, sf_dir), spark, sf_dir), "mean")


@query(WORDS + "select experiment, subdir_str, frame_no, parity, pos, floor(value * 1e6 + 0.5e0) / 1e6 as value from subtracted")
def background_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_subtracted(spark, sf_dir), "value")


@query(
    WORDS
    + """select experiment, subdir_str, frame_no, parity, pos,
  floor((cast(cast(value * case when frame_no < 2 * (n_frames // 2) then flat else 1 end as float) as double)) * 1e4 + 0.5e0) / 1e4 as value
from decoded join scans using (experiment, subdir_str)"""
)
def flat_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = cal.to_long(I.small_calibration(spark))
    pixels = flatfield.apply_flat_field(_decoded(spark, sf_dir), masks, _scans(spark, sf_dir))
    return rounded(flatfield.narrow(pixels), "value", digits=4)


@query(
    WORDS
    + "select experiment, subdir_str, cast(frame_no // 4 + 1 as bigint) as chunk_i, frame_no, parity, pos, w from words where block % 10 <> 7"
)
def raw_decode_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload bytes to frames of words, through the chunk selection of the production plan."""
    packets, folder = I.landed_embedding_packets(spark, sf_dir)
    facts = assemble.acquisition_facts(assemble.chunk_facts(packets), I.SMALL.frame_bytes)
    facts = save(assemble.with_operation_file(facts, packets), f"{folder}/facts")
    chunks = correction.select_chunks(packets, facts, I.SMALL.frame_bytes)
    return decode.explode_pixels(decode.unpack_frames(chunks, I.SMALL), "w")


def _corrected(spark: SparkSession, sf_dir: str, packed: bool = False, with_pixels: bool = True) -> DataFrame:
    packets, folder = I.landed_embedding_packets(spark, sf_dir)
    calibration = cal.as_arrays(I.small_calibration(spark), I.SMALL)
    ready = correction.find_ready(packets, I.SMALL, folder)
    means = correction.compute_means(packets, ready, calibration, I.SMALL)
    means = store_noise_means(means, f"{folder}/noise_means")
    return correction.correct_signals(packets, ready.signals, means, calibration, I.SMALL, packed=packed, with_pixels=with_pixels)


def _corrected_pixels(frames: DataFrame) -> DataFrame:
    pixels = decode.explode_pixels(frames.select(*FRAME, "pixels"))
    return rounded(pixels, "value", digits=4)


@query(CORRECTED_PIXELS)
def corrected_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: packets to corrected frames in the production form, shown pixel by pixel."""
    return _corrected_pixels(_corrected(spark, sf_dir))


@query(
    CORRECTED
    + """select experiment, subdir_str, concat('hist_', subdir_str, '.txt') as log_name, frame_no,
  concat(any_value(hist_max), ' : ', any_value(hist_arg)) as line from corrected group by experiment, subdir_str, frame_no"""
)
def histogram_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_lines(correction.frame_stats(_corrected(spark, sf_dir, with_pixels=False)))


@query(
    CORRECTED
    + """select experiment, concat('hist_', subdir_str, '.txt') as log_name, frame_no,
  concat(any_value(hist_max), ' : ', any_value(hist_arg)) as line from corrected group by experiment, subdir_str, frame_no"""
)
def histogram_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs written in two calls and read back; a line's place in its files, in name order, is its frame."""
    root = f"{shared_dir(spark)}/logs"
    stats = save(correction.frame_stats(_corrected(spark, sf_dir, with_pixels=False)), f"{root}.stats")
    write_log(stats.filter("crc32(subdir_str) % 2 = 0"), root)
    write_log(stats.filter("crc32(subdir_str) % 2 = 1"), root)
    return read_log(spark, root)


@query(
    CORRECTED
    + """select experiment, subdir_str, frame_no, any_value(hist_max) as hist_max, any_value(hist_arg) as hist_arg,
  floor((any_value("offset")) * 1e6 + 0.5e0) / 1e6 as "offset" from corrected group by experiment, subdir_str, frame_no"""
)
def frame_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correction.frame_stats(_corrected(spark, sf_dir, with_pixels=False)), "offset")


@query(CORRECTED_PIXELS)
def raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrected frames written as headerless float32 files and read back from them."""
    root = f"{shared_dir(spark)}/output"
    export_raw(_corrected(spark, sf_dir, packed=True), root, frames_per_file=10)
    return _corrected_pixels(read_exported(spark, root, I.SMALL))


@query(CORRECTED_PIXELS)
def raw_roundtrip_big_endian(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{shared_dir(spark)}/output"
    export_raw(_corrected(spark, sf_dir, packed=True), root, byte_order=">", frames_per_file=10)
    return _corrected_pixels(read_exported(spark, root, I.SMALL, byte_order=">"))


@query(CORRECTED_PIXELS)
def stream_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same packets as a stream in two micro-batches."""
    folder = shared_dir(spark)
    tables = streaming.Tables(f"{folder}/stream", partition_by=[])
    calibration = cal.as_arrays(I.small_calibration(spark), I.SMALL)
    packets = _incoming(I.embedding_packets(spark, sf_dir), f"{folder}/incoming")
    handler = streaming.correct_completed(tables, calibration, I.SMALL)
    streaming.start(packets, handler, tables, once=True).awaitTermination()
    return _corrected_pixels(decode.unpack_pixels(tables.corrected(spark), I.SMALL))


@query(
    CORRECTED
    + """select experiment, subdir_str, frame_no, pos, floor((cast(value as double)) * 1e4 + 0.5e0) / 1e4 as value,
  concat(hist_max, ' : ', hist_arg) as line from corrected"""
)
def run_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run that also writes its logs and raw files; both read back and joined."""
    packets, folder = I.landed_embedding_packets(spark, sf_dir)
    calibration = cal.as_arrays(I.small_calibration(spark), I.SMALL)
    correct_packets(packets, calibration, I.SMALL, f"{folder}/run", outputs=Outputs(log=True, raw="<"))
    raw = raw_table(spark, f"{folder}/run")
    pixels = _corrected_pixels(read_listed(raw.load(), raw.files_path, I.SMALL))
    lines = log_table(spark, f"{folder}/run").load().withColumn("subdir_str", F.regexp_extract("log_name", r"^hist_(.*)\.txt$", 1)).drop("log_name")
    return pixels.join(lines, FRAME)


@query(
    WORDS
    + """select m.experiment, m.noise_subdir, m.parity, m.pos, floor(m.mean * 1e6 + 0.5e0) / 1e6 as mean,
  cast(substr(m.experiment, 5) as bigint) % 2 = 0 as reused
from means m where m.noise_subdir in (select subdir_str from words group by subdir_str having count(distinct frame_no // 4) = 7)"""
)
def reuse_noise_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of even experiments are stored first; the second run computes only the missing ones."""
    packets, folder = I.landed_embedding_packets(spark, sf_dir)
    calibration = cal.as_arrays(I.small_calibration(spark), I.SMALL)
    means_path = f"{folder}/noise_means"
    first = correction.find_ready(
        packets.filter("cast(substring(experiment, 5) as bigint) % 2 = 0"), I.SMALL, f"{folder}/gate1"
    )
    stored = store_noise_means(correction.compute_means(packets, first, calibration, I.SMALL), means_path)
    second = correction.find_ready(packets, I.SMALL, f"{folder}/gate2", stored_means=stored)
    fresh = correction.compute_means(packets, second, calibration, I.SMALL)
    columns = ["experiment", "noise_subdir", "parity", "pixels"]
    both = stored.select(*columns, F.lit(True).alias("reused")).unionByName(
        fresh.select(*columns, F.lit(False).alias("reused"))
    )
    return rounded(decode.explode_pixels(both, "mean"), "mean")


# Readings from events

READINGS = "with " + I.READINGS_SQL
READING_OFFSETS = READINGS + "," + I.offsets_sql("readings", "frame")


@query(
    READINGS
    + """select frame, least(cast(floor((value + 205) / 10) as bigint), 41) as bin, count(*) as n
from readings where value >= -205 and value < 215 group by all"""
)
def frame_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debounce.frame_histogram(I.event_readings(spark, sf_dir), ["frame"])


@query(
    READINGS
    + """select cast(-205 + 10 * i as double) as edge, count(r.value) as n from unnest(range(42)) t(i)
left join readings r on least(cast(floor((r.value + 205) / 10) as bigint), 41) = i and r.value >= -205 and r.value < 215 group by i"""
)
def edge_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of all frames on the layout's edges, empty bins included."""
    rule = debounce.RULE
    edges = matrix.arange(rule.low, rule.high - rule.step, rule.step)
    layout = spark.range(1).select(F.posexplode(edges).alias("bin", "edge"))
    counts = debounce.frame_histogram(I.event_readings(spark, sf_dir), ["frame"]).groupBy(F.col("bin").cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    return layout.join(counts, "bin", "left").select("edge", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


@query(READING_OFFSETS + "select frame, hist_max, hist_arg from offsets")
def histogram_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debounce.histogram_mode(I.event_readings(spark, sf_dir), ["frame"])


@query(READING_OFFSETS + 'select frame, hist_max, hist_arg, floor("offset" * 1e6 + 0.5e0) / 1e6 as "offset" from offsets')
def debounce_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(debounce.frame_offsets(I.event_readings(spark, sf_dir), ["frame"]), "offset")


@query(READING_OFFSETS + 'select frame, event_id, floor((value - "offset") * 1e6 + 0.5e0) / 1e6 as value from readings join offsets using (frame)')
def debounce_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = I.event_readings(spark, sf_dir)
    offsets = debounce.frame_offsets(readings, ["frame"])
    return rounded(debounce.remove_offsets(readings, offsets, ["frame"]), "value")


# Matrices from embeddings


@query(
    """with e as (select vec_id, embedding as a, list_reverse(embedding) as b, unnest(range(64)) as pos from embeddings)
select vec_id, cast(pos as int) as pos, floor((a[pos + 1]::double * b[pos + 1]::double) * 1e6 + 0.5e0) / 1e6 as product,
  floor((a[pos + 1]::double - b[pos + 1]::double) * 1e6 + 0.5e0) / 1e6 as difference,
  floor(((a[pos + 1]::double + b[pos + 1]::double)::float::double) * 1e6 + 0.5e0) / 1e6 as narrow_sum,
  floor((a[(pos % 8) * 8 + pos // 8 + 1]::double) * 1e6 + 0.5e0) / 1e6 as transposed, floor((a[pos + 1]::double) * 1e6 + 0.5e0) / 1e6 as flat,
  cast(list_position(a, list_max(a)) - 1 as int) as largest from e"""
)
def matrix_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8 x 8 matrices: element-wise algebra, reshaping and flattening."""
    m = I.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    m = m.withColumn("b", F.reverse("a"))
    m = m.select(
        "vec_id",
        matrix.largest_index(F.col("a")).alias("largest"),
        matrix.reshape_2d(F.col("a"), 8, 8).alias("square"),
        F.posexplode(
            F.arrays_zip(
                matrix.hadamard(F.col("a"), F.col("b")).alias("product"),
                matrix.subtract(F.col("a"), F.col("b")).alias("difference"),
                matrix.add_narrow(F.col("a"), F.col("b")).alias("narrow_sum"),
                matrix.flatten_3d(matrix.reshape_3d(F.col("a"), 4, 4, 4)).alias("flat"),
            )
        ).alias("pos", "m"),
    )
    m = m.select("vec_id", "pos", "largest", "m.*", F.expr("square[pos % 8][pos div 8]").alias("transposed"))
    return rounded(m, "product", "difference", "narrow_sum", "flat", "transposed")
