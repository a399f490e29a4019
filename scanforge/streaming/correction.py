"""Correct each acquisition once, as soon as it and its noise are complete."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scanforge.config import ACQUISITION, RAW_SCAN_NAME, Geometry, OffsetRule
from scanforge.operators.integrity import POLICIES, check_integrity
from scanforge.plans.correction import choose_ready
from scanforge.plans.ledger import Ledger
from scanforge.plans.run import Outputs, corrected_table, processed_table, store_corrections
from scanforge.plans.tables import save
from scanforge.schema import LANDED_SCHEMA
from scanforge.sinks.histogram_log import log_table
from scanforge.sinks.raw import raw_table
from scanforge.sinks.tables import noise_means_table
from scanforge.streaming.gate import Gate
from scanforge.streaming.progress import ProgressLines, observe_packets

COMPLETED_SCHEMA = "experiment string, subdir_str string, n_received bigint, n_chunks bigint, n_total_chunks bigint"
BATCH = ", batch_id bigint"


@dataclass
class Tables:
    """Folders of one stream. Everything it keeps is here, so a restart needs nothing else.

    ``policy`` says what becomes of packets whose hash doesn't match: ``keep`` them with the others, ``drop`` them, or put them
    into a table of their own (``quarantine``).
    """

    root: str
    partition_by: list[str] = field(default_factory=lambda: list(ACQUISITION))
    policy: str = "keep"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def packet_table(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, self.path("packets"), LANDED_SCHEMA + BATCH, tuple(self.partition_by))

    def quarantine_table(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, self.path("quarantine"), LANDED_SCHEMA + BATCH)

    def completed_table(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, self.path("completed"), COMPLETED_SCHEMA + BATCH)

    def packets(self, spark: SparkSession) -> DataFrame:
        return self.packet_table(spark).load()

    def quarantined(self, spark: SparkSession) -> DataFrame:
        return self.quarantine_table(spark).load()

    def noise_means(self, spark: SparkSession) -> DataFrame:
        return noise_means_table(spark, self.path("noise_means")).load()

    def corrected(self, spark: SparkSession) -> DataFrame:
        return corrected_table(spark, self.root).load()

    def processed(self, spark: SparkSession) -> DataFrame:
        return processed_table(spark, self.root).load()

    def completed(self, spark: SparkSession) -> DataFrame:
        return self.completed_table(spark).load()

    def log(self, spark: SparkSession) -> DataFrame:
        return log_table(spark, self.root).load()

    def raw_files(self, spark: SparkSession) -> DataFrame:
        return raw_table(spark, self.root).load()


def land_batch(batch: DataFrame, batch_id: int, tables: Tables) -> DataFrame:
    """Store a micro-batch's packets, by the policy in one or two tables, and return what was landed of it.

    A repeated batch replaces itself in both.
    """
    spark = batch.sparkSession
    if tables.policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    checked = check_integrity(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    landed = tables.packet_table(spark)
    folder = landed.folder(batch_id)
    if tables.policy == "quarantine":
        # Two sinks read the batch; it is hashed once.
        checked = checked.persist()
    landed.write(checked if tables.policy == "keep" else checked.filter("hash_ok"), folder)
    if tables.policy == "quarantine":
        tables.quarantine_table(spark).append(checked.filter("not hash_ok"), batch_id)
        checked.unpersist()
    landed.commit(batch_id, [folder])
    return landed.load(first=batch_id).filter(F.col("batch_id") == batch_id)


def record_completed(tables: Tables, raw_name: str = RAW_SCAN_NAME) -> Callable[[DataFrame, int], None]:
    """Batch handler that only lands packets and records which acquisitions became complete."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        landed = land_batch(batch, batch_id, tables)
        gate = Gate(spark, tables.root, tables.packet_table(spark), tables.completed_table(spark))
        state, facts = gate.advance(landed, batch_id, 1, raw_name)
        new = facts.filter("complete and not done").select("experiment", "subdir_str", "n_received", "n_chunks", "n_total_chunks")
        new = save(new.withColumn("batch_id", F.lit(batch_id).cast("bigint")), tables.path(f"gate/batch_id={batch_id}/completed"))
        tables.completed_table(spark).append(new, batch_id)
        gate.retire(state, landed, new, batch_id, raw_name)

    return handle


def correct_completed(
    tables: Tables,
    calibration: dict,
    geometry: Geometry,
    rule: OffsetRule = OffsetRule(),
    raw_name: str = RAW_SCAN_NAME,
    treat_extra_noise_as_signal: bool = False,
    outputs: Outputs = Outputs(),
) -> Callable[[DataFrame, int], None]:
    """Batch handler for the whole correction.

    Each output is listed under the id of its batch, so running a batch twice gives what running it
    once gives.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        landed = land_batch(batch, batch_id, tables)
        packets = tables.packet_table(spark)
        gate = Gate(spark, tables.root, packets, processed_table(spark, tables.root))
        state, facts = gate.advance(landed, batch_id, geometry.frame_bytes, raw_name)
        ready = choose_ready(
            facts.drop("first_batch", "done"),
            tables.path(f"gate/batch_id={batch_id}"),
            stored_means=noise_means_table(spark, tables.path("noise_means")).load(before=batch_id),
            processed=facts.filter("done"),
            treat_extra_noise_as_signal=treat_extra_noise_as_signal,
        )
        # Payload is read of the acquisitions at hand, from the batches since the first of them began.
        begun = ready.signals.select(*ACQUISITION).union(ready.noises.select(*ACQUISITION))
        first = facts.join(begun, ACQUISITION, "left_semi").agg(F.min("first_batch")).first()[0]
        store_corrections(
            packets.load(first=first), ready, calibration, geometry, tables.root, batch_id, tables.partition_by, rule, raw_name, outputs
        )
        gate.retire(state, landed, ready.signals, batch_id, raw_name)

    return handle


def start(
    packets: DataFrame,
    handler: Callable[[DataFrame, int], None],
    tables: Tables,
    once: bool = False,
    policy: str | None = None,
    emit: Callable[[str], None] | None = print,
) -> StreamingQuery:
    """Run a batch handler over a packet stream; progress is kept in ``{root}/checkpoint``.

    ``policy`` overrides that of ``tables``, with which the handler lands. ``emit`` gets a line for each batch with packets, from a
    listener that lives as long as the query; None means no lines.
    """
    if policy is not None:
        tables.policy = policy
    spark = packets.sparkSession
    listener = ProgressLines(emit).attach(spark) if emit else None
    observed = observe_packets(packets, listener.metrics) if listener else packets
    writer = observed.writeStream.foreachBatch(handler).option("checkpointLocation", tables.path("checkpoint"))
    try:
        return (writer.trigger(availableNow=True) if once else writer).start()
    except Exception:
        if listener:
            listener.detach()
        raise
