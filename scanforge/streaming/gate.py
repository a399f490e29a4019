"""The gate of a stream: mergeable facts of open acquisitions, so that a batch costs what it brings.

An acquisition's state is a few rows: for every 32,768 chunk numbers a bitmap of those received, with counts, lengths and first
arrival. All of it merges by sums, extremes and bitwise or. A batch merges its own packets' facts with the state before it; packets of
earlier batches aren't read again. What is processed leaves the state, except noises, which go on deciding who is the active noise.

Sums are exact as long as each chunk came once, which the bitmap tells. Where one came again, exact facts are read from the landed
metadata of that acquisition alone, once it has all its chunks and again only when more of its packets arrive.

New acquisitions are looked up in the list of processed ones, a narrow row for each acquisition ever processed: late packets of those are
left out, and their directories are known to hold an operation file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanforge.config import ACQUISITION
from scanforge.operators import assemble
from scanforge.operators.select import kind, operation_files, raw_scans
from scanforge.plans.joins import lookup_join
from scanforge.plans.ledger import Ledger
from scanforge.plans.tables import save

STATE_SCHEMA = (
    "experiment string, subdir_str string, bucket bigint, bitmap binary, n_received bigint, n_total_chunks bigint, n_bytes bigint, "
    "first_arrival decimal(38,0), _first bigint, _last bigint, _short bigint, _long bigint, n_broken bigint, first_batch bigint, last_batch bigint, "
    "has_operation boolean, done boolean"
)
OPERATIONS_SCHEMA = "subdir_str string"
EXACT_SCHEMA = (
    "experiment string, subdir_str string, kind string, n_received bigint, n_chunks bigint, n_total_chunks bigint, complete boolean, n_broken bigint, "
    "n_frames bigint, body_frames bigint, clean boolean, first_arrival decimal(38,0), as_of bigint"
)
KEY = [*ACQUISITION, "bucket"]


def batch_state(packets: DataFrame, batch_id: int, frame_bytes: int, raw_name: str) -> DataFrame:
    """State rows of one batch's landed packets."""
    body = F.when(F.col("chunk_i") < F.col("n_total_chunks"), F.col("n_bytes"))
    return raw_scans(packets, raw_name).groupBy(*ACQUISITION, F.bitmap_bucket_number("chunk_i").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("chunk_i")).alias("bitmap"),
        F.count("*").alias("n_received"),
        F.max("n_total_chunks").alias("n_total_chunks"),
        F.sum("n_bytes").alias("n_bytes"),
        F.min(F.col("arrival_order").cast("decimal(38,0)")).alias("first_arrival"),
        F.min("chunk_i").alias("_first"),
        F.max("chunk_i").alias("_last"),
        F.min(body).alias("_short"),
        F.max(body).alias("_long"),
        F.count_if(F.coalesce("n_bytes", F.lit(-1)) % frame_bytes != 0).alias("n_broken"),
        F.lit(batch_id).cast("bigint").alias("first_batch"),
        F.lit(batch_id).cast("bigint").alias("last_batch"),
        F.lit(False).alias("has_operation"),
        F.lit(False).alias("done"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    low = ["first_arrival", "_first", "_short", "first_batch"]
    high = ["n_total_chunks", "_last", "_long", "last_batch", "has_operation", "done"]
    added = ["n_received", "n_bytes", "n_broken"]
    merged = {c: F.min(c) for c in low} | {c: F.max(c) for c in high} | {c: F.sum(c) for c in added} | {"bitmap": F.bitmap_or_agg("bitmap")}
    names = [c.split()[0] for c in STATE_SCHEMA.split(", ")]
    return states.groupBy(*KEY).agg(*[merged[c].alias(c) for c in names if c not in KEY]).select(*names)


def state_sums(state: DataFrame) -> DataFrame:
    """One row per acquisition; a chunk without a number counts as one chunk."""
    n_chunks = F.when(F.col("bucket").isNull(), F.lit(1).cast("bigint")).otherwise(F.bitmap_count("bitmap"))
    extremes = [F.max("n_total_chunks").alias("n_total_chunks"), F.min("first_arrival").alias("first_arrival"), F.min("_first").alias("_first"), F.max("_last").alias("_last")]
    extremes += [F.min("_short").alias("_short"), F.max("_long").alias("_long"), F.min("first_batch").alias("first_batch"), F.max("last_batch").alias("last_batch")]
    extremes += [F.max("has_operation").alias("has_operation"), F.max("done").alias("done")]
    return state.groupBy(*ACQUISITION).agg(F.sum("n_received").alias("n_received"), F.sum(n_chunks).alias("n_chunks"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_broken").alias("n_broken"), *extremes)


@dataclass
class Gate:
    """The gate's tables below ``{root}/state``, each replaced by every batch; ``processed`` lists what is done."""

    spark: SparkSession
    root: str
    packets: Ledger
    processed: Ledger
    found_exact: DataFrame | None = None

    def _table(self, name: str, schema: str) -> Ledger:
        return Ledger(self.spark, f"{self.root}/state/{name}", schema)

    @property
    def state(self) -> Ledger:
        return self._table("open", STATE_SCHEMA)

    @property
    def operations(self) -> Ledger:
        return self._table("operations", OPERATIONS_SCHEMA)

    @property
    def exact(self) -> Ledger:
        return self._table("exact", EXACT_SCHEMA)

    def advance(self, landed: DataFrame, batch_id: int, frame_bytes: int, raw_name: str) -> tuple[DataFrame, DataFrame]:
        """Merge a batch's landed packets. Gives (state rows, facts of the open acquisitions with an operation file), both stored.

        Nothing but scratch below ``gate/batch_id=…`` is written, so a batch may run again; ``retire`` ends it.
        """
        folder = f"{self.root}/gate/batch_id={batch_id}"
        before = self.state.load(before=batch_id)
        fresh = batch_state(landed, batch_id, frame_bytes, raw_name)
        # Noises stay in the state when they are processed, so only acquisitions that left it are late.
        processed = self.processed.load(before=batch_id).select(*ACQUISITION)
        gone = processed.join(before.select(*ACQUISITION), ACQUISITION, "left_anti")
        merged = merge_states(before.unionByName(fresh.join(gone, ACQUISITION, "left_anti")))
        directories = self._operations(landed, batch_id, raw_name).union(processed.select("subdir_str")).distinct().withColumn("_found", F.lit(True))
        has = F.col("has_operation") | F.coalesce("_found", F.lit(False))
        state = merged.join(directories, "subdir_str", "left").withColumn("has_operation", has).select(*before.columns)
        state = save(state, f"{folder}/state")
        return state, save(self._facts(state, batch_id, frame_bytes, raw_name), f"{folder}/open_facts")

    def _operations(self, landed: DataFrame, batch_id: int, raw_name: str) -> DataFrame:
        """Directories whose operation file came in this batch, or came before and aren't processed."""
        return self.operations.load(before=batch_id).union(operation_files(landed, raw_name).select("subdir_str"))

    def _repeated(self, state: DataFrame) -> DataFrame:
        """Acquisitions with all their chunks of which some came more than once."""
        sums = state_sums(state).where("has_operation")
        full = (F.col("n_received") != F.col("n_chunks")) & (F.col("n_chunks") >= F.col("n_total_chunks"))
        return sums.where(full).select(*ACQUISITION, "first_batch", F.col("last_batch").alias("as_of"))

    def _exact(self, state: DataFrame, batch_id: int, frame_bytes: int, raw_name: str) -> DataFrame | None:
        """Exact facts of those; None if there are none."""
        names = self._repeated(state)
        kept = self.exact.load(before=batch_id).join(names.select(*ACQUISITION, "as_of"), [*ACQUISITION, "as_of"], "left_semi")
        stale = names.join(kept, ACQUISITION, "left_anti")
        known, first = names.join(stale.select(*ACQUISITION, F.lit(True).alias("stale")), ACQUISITION, "left").agg(
            F.count("*"), F.min(F.when(F.col("stale"), F.col("first_batch")))
        ).first()
        if not known:
            return None
        if first is None:
            return kept
        packets = lookup_join(self.packets.load(first=first), stale.select(*ACQUISITION), ACQUISITION, salt=F.col("chunk_i"), how="left_semi")
        read = assemble.acquisition_facts(assemble.chunk_facts(packets, raw_name), frame_bytes)
        return kept.unionByName(read.join(stale.select(*ACQUISITION, "as_of"), ACQUISITION).select(*kept.columns))

    def _facts(self, state: DataFrame, batch_id: int, frame_bytes: int, raw_name: str) -> DataFrame:
        sums = state_sums(state).where("has_operation")
        exact = self._exact(state, batch_id, frame_bytes, raw_name)
        self.found_exact = None
        if exact is None:
            facts = assemble.facts_of_sums(sums, frame_bytes)
        else:
            self.found_exact = exact = save(exact, f"{self.root}/gate/batch_id={batch_id}/exact")
            # What isn't complete by number is not complete, whatever its copies hold.
            plain = assemble.facts_of_sums(sums.join(exact.select(*ACQUISITION), ACQUISITION, "left_anti"), frame_bytes)
            facts = plain.unionByName(exact.select(*plain.columns))
        return facts.join(sums.select(*ACQUISITION, "first_batch", "done"), ACQUISITION)

    def retire(self, state: DataFrame, landed: DataFrame, done: DataFrame, batch_id: int, raw_name: str) -> None:
        """Store the state after a batch, without the acquisitions ``done`` that it processed."""
        names = done.select(*ACQUISITION).distinct().withColumn("_now", F.lit(True))
        marked = state.join(names, ACQUISITION, "left").withColumn("done", F.col("done") | F.coalesce("_now", F.lit(False))).drop("_now")
        self.state.replace(marked.where((kind() == "noise") | ~F.col("done")).select(*state.columns).coalesce(8), batch_id)
        # The list of processed acquisitions stands for the directories of those.
        operations = self._operations(landed, batch_id, raw_name).distinct().join(done.select("subdir_str").distinct(), "subdir_str", "left_anti")
        self.operations.replace(operations.coalesce(8), batch_id)
        if self.found_exact is not None:
            self.exact.replace(self.found_exact.join(done.select(*ACQUISITION), ACQUISITION, "left_anti").coalesce(8), batch_id)
