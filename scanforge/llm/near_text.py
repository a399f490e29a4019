"""Near-duplicate texts by MinHash.

Texts become sets of word shingles. Minima of many universal hash functions form a signature; texts that agree in all rows of
a band are candidates; signatures prune them, and full sets confirm them. Components of the confirmed links come from
alternating large-star and small-star.

Nothing emits all pairs of a group. Texts with equal sets are one node. Every node is first compared with the smallest node
of all its buckets only; that joins large groups of copies. What is left are buckets with nodes of several components: there
nodes outside of the largest component are compared with the others in blocks by signature, and for each other component only the
likeliest partner leaves a block. It is confirmed on the full sets; where it fails and more were likely, the node is
compared with the whole component on the full sets, in blocks again. Blocks are bounded and spread over tasks.

Chance of losing a link at exactly the threshold 0.8: below 1e-7 by banding (32 bands of 4), below 1e-6 by the
signature test (five standard deviations). Links at a higher similarity are safer still.

Defined results: a null or blank text has an empty set and links with nothing; rows that share a doc_id are
judged each by its own text (ids are expected to name one text); a row without doc_id links with nothing and is kept; extra columns don't matter; an empty table gives an empty table.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType

from scanforge.llm.common import Scratch, text_batches
from scanforge.llm.components import components
from scanforge.plans.joins import lookup_join

BANDS = 32
ROWS = 4
HASHES = BANDS * ROWS
MIN_PERCENT = 80
# Least share of equal minima: 0.8 less five standard deviations of HASHES draws.
MIN_EQUAL = int(HASHES * (0.8 - 5 * (0.8 * 0.2 / HASHES) ** 0.5))
BLOCK = 64
STEP = 2048


def word_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes; only A-Z are lower-cased."""
    ids: dict[bytes, int] = {}
    rows = [[ids.setdefault(w, len(ids)) for w in t.lower().split()] if t else [] for t in texts]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in ids), np.uint64, len(ids))
    factor = np.uint64(0x9E3779B97F4A7C15)
    sets = []
    for row in rows:
        h = hashes[row] if row else np.empty(0, np.uint64)
        n = max(len(h) - width + 1, min(1, len(h)))
        x = np.full(n, min(len(h), width), np.uint64)
        for k in range(min(len(h), width)):
            x = x * factor + h[k : k + n]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        sets.append(np.unique(x))
    return sets


def hash_functions(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add-shift functions on 64-bit numbers."""
    draw = np.random.default_rng(seed)
    return draw.integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 2**63, HASHES, np.uint64)


def signature(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> bytes:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), STEP):
        x = shingles[i : i + STEP, None] * factors
        x += offsets
        np.minimum(least, x.min(0), out=least)
    return (least >> np.uint64(32)).astype("<u4").tobytes()


def sketch_of(text: Column, width: int) -> Column:
    """struct(n: size of the set, digest: of the set, sig: minima); digest and sig are null for an empty set."""
    factors, offsets = hash_functions()

    @F.arrow_udf("struct<n:bigint,digest:binary,sig:binary>")
    def sketched(texts: pa.Array) -> pa.Array:
        sets = word_sets(texts.to_pylist(), width)
        return pa.StructArray.from_arrays(
            [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array([signature(s, factors, offsets) if len(s) else None for s in sets], pa.binary()),
            ],
            ["n", "digest", "sig"],
        )

    return sketched(text.cast("binary"))


@F.arrow_udf(BooleanType())
def likely_similar(a: pa.Array, b: pa.Array) -> pa.Array:
    x, y = (np.frombuffer(b"".join(s.to_pylist()), "<u4").reshape(-1, HASHES) for s in (a, b))
    return pa.array((x == y).sum(1) >= MIN_EQUAL)


def shingle_set(text: bytes, width: int) -> set:
    words = text.lower().split()
    if len(words) <= width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(width))))


def similar_on_full_sets(a: Column, b: Column, width: int, min_percent: int) -> Column:
    @F.arrow_udf("boolean")
    def confirmed(left: pa.Array, right: pa.Array) -> pa.Array:
        out, last, held = [], None, set()
        for x, y in zip(left.to_pylist(), right.to_pylist()):
            if x != last:
                last, held = x, shingle_set(x, width)
            other = shingle_set(y, width)
            common = len(held & other)
            out.append(100 * common >= min_percent * (len(held) + len(other) - common))
        return pa.array(out, pa.bool_())

    return confirmed(a.cast("binary"), b.cast("binary"))


def confirm(docs: DataFrame, pairs: DataFrame, width: int, min_percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Those of ``pairs`` (a, b) that are similar on their full sets."""
    pairs = scratch.save(pairs, f"{name}_pairs")
    nodes = scratch.save(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{name}_nodes")
    texts = scratch.save(lookup_join(docs.select("doc_id", "text").where(F.col("text").isNotNull()), nodes, ["doc_id"], None, "left_semi"), f"{name}_texts")
    both = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right")), "b").join(
        texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left")), "a"
    )
    found = both.where(similar_on_full_sets(F.col("left"), F.col("right"), width, min_percent)).select("a", "b").distinct()
    found = scratch.save(found, f"{name}_links")
    scratch.drop(f"{name}_nodes", f"{name}_texts")
    scratch.release()
    return found


def with_signatures(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    sig = nodes.select("node", "sig")
    return (
        pairs.join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
        .join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
        .where(likely_similar("sig_a", "sig_b"))
        .select("a", "b")
    )


def compare_block(table: pa.Table) -> pa.Table:
    """For each minor node and other component of a block pair: the likeliest partner and the number of likely ones.

    Pairs count in the first bucket where they meet.
    """
    node, part = table["node"].to_numpy(), table["component"].to_numpy()
    minor = table["minor"].to_numpy()
    band = table["band"][0].as_py()
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), "<u4").reshape(-1, HASHES)
    right = np.flatnonzero(~minor)
    rows = []
    for i in np.flatnonzero(minor):
        j = right[part[right] != part[i]]
        same = sig[j] == sig[i]
        equal = same.sum(1)
        likely = (equal >= MIN_EQUAL) & (same.reshape(len(j), BANDS, ROWS).all(2).argmax(1) == band)
        j, equal = j[likely], equal[likely]
        for c in np.unique(part[j]):
            mine = part[j] == c
            best = j[mine][equal[mine].argmax()]
            rows.append((int(node[i]), int(c), int(node[best]), int(equal[mine].max()), int(mine.sum())))
    columns = list(zip(*rows)) or [[]] * 5
    return pa.table({k: pa.array(v, pa.int64()) for k, v in zip(("a", "c", "b", "equal", "n"), columns)})


def block(n: str) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(5)), F.col(n)).cast("int")


def every_block(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def bucket_rest(members: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, c, b, n): node, another component with likely partners in a common bucket, the likeliest one, and their number.

    Nodes outside of a bucket's largest component meet all nodes of the bucket; either side is cut into blocks of about
    BLOCK nodes by hash, and each pair of blocks is a group of its own.
    """
    marked = members.join(labels, "node", "left").select("key", "band", "node", F.coalesce("component", "node").alias("component"))
    parts = marked.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key")
    mixed = parts.agg(F.count("*").alias("parts"), F.sum("n").alias("m"), F.max(F.struct("n", "component")).alias("largest")).where("parts > 1")
    mixed = mixed.select(
        "key",
        F.col("largest.component").alias("major"),
        F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("m") - F.col("largest.n")) / BLOCK).cast("int").alias("minor_blocks"),
    )
    rows = marked.join(mixed, "key").join(nodes.select("node", "sig"), "node")
    columns = ["key", "band", "node", "component", "sig"]
    everyone = rows.select(*columns, block("blocks").alias("i"), every_block("minor_blocks").alias("j"), F.lit(False).alias("minor"))
    minors = rows.where("component != major").select(*columns, every_block("blocks").alias("i"), block("minor_blocks").alias("j"), F.lit(True).alias("minor"))
    found = everyone.union(minors).groupBy("key", "i", "j").applyInArrow(compare_block, "a bigint, c bigint, b bigint, equal bigint, n bigint")
    best = found.groupBy("a", "c").agg(F.max(F.struct("equal", "b")).alias("best"), F.sum("n").alias("n"))
    return best.select("a", "c", "best.b", "n")


def join_block(min_percent: int):
    """A link from each single node of a block pair to the component's members, if one is similar on the full sets."""

    def compare(table: pa.Table) -> pa.Table:
        node, single = table["node"].to_numpy(), table["single"].to_numpy()
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), "<u4").reshape(-1, HASHES)
        sets = [np.frombuffer(x, "<u8") for x in table["shingles"].to_pylist()]
        members, a, b = np.flatnonzero(~single), [], []
        for i in np.flatnonzero(single):
            for j in members[(sig[members] == sig[i]).sum(1) >= MIN_EQUAL]:
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common >= min_percent * (len(sets[i]) + len(sets[j]) - common):
                    a.append(int(node[i]))
                    b.append(int(node[j]))
                    break
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def shingles_of(text: Column, width: int) -> Column:
    @F.arrow_udf(BinaryType())
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([x.astype("<u8").tobytes() for x in word_sets(texts.to_pylist(), width)], pa.binary())

    return hashed(text.cast("binary"))


def join_components(docs: DataFrame, wanted: DataFrame, labels: DataFrame, nodes: DataFrame, width: int, min_percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between nodes and components, at most one for each pair (a, c) of ``wanted`` and block.

    A component is linked in itself, so one link joins a node to all of it. Nodes and members are cut into blocks.
    """
    members = labels.join(wanted.select(F.col("c").alias("component")).distinct(), "component").select(F.col("component").alias("c"), "node")
    singles = wanted.select("c", F.col("a").alias("node"))
    sizes = members.groupBy("c").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).join(
        singles.groupBy("c").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("single_blocks")), "c"
    )
    sizes = scratch.save(sizes, "join_sizes")
    ids = scratch.save(members.select("node").union(singles.select("node")).distinct(), "join_nodes")
    texts = lookup_join(docs.select(F.col("doc_id").alias("node"), "text").where(F.col("text").isNotNull()), ids, ["node"], None, "left_semi")
    sets = scratch.save(texts.select("node", shingles_of(F.col("text"), width).alias("shingles")), "join_sets")
    sets = sets.join(nodes.select("node", "sig"), "node")
    one = members.join(sizes, "c").select("c", "node", block("blocks").alias("i"), every_block("single_blocks").alias("j"), F.lit(False).alias("single"))
    two = singles.join(sizes, "c").select("c", "node", every_block("blocks").alias("i"), block("single_blocks").alias("j"), F.lit(True).alias("single"))
    rows = one.union(two).join(sets, "node")
    found = scratch.save(rows.groupBy("c", "i", "j").applyInArrow(join_block(min_percent), "a bigint, b bigint"), "join_links")
    scratch.drop("join_sizes", "join_nodes", "join_sets")
    scratch.release()
    return found


def near_duplicates(docs: DataFrame, width: int = 5, min_percent: int = MIN_PERCENT, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    text_batches(spark)
    sketched = docs.select("doc_id", sketch_of(F.col("text"), width).alias("s")).select("doc_id", "s.*")
    sketched = scratch.save(sketched, "sketches")
    nodes = sketched.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull()).groupBy("digest")
    nodes = scratch.save(nodes.agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig")), "nodes")

    band = lambda b: F.struct(F.lit(b).alias("band"), F.xxhash64(F.substring("sig", 4 * ROWS * b + 1, 4 * ROWS), F.lit(b)).alias("key"))
    rows = nodes.select("node", F.explode(F.array(*[band(b) for b in range(BANDS)])).alias("x")).select("x.key", "x.band", "node")
    buckets = rows.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("last")).where("center < last").select("key", "center")
    members = scratch.save(rows.join(scratch.save(buckets, "buckets"), "key"), "members")

    # A node meets the smallest center of all its buckets, so this is one pair for each node however large the buckets are.
    stars = members.groupBy("node").agg(F.min("center").alias("a")).where("a < node").select("a", F.col("node").alias("b"))
    star_links = confirm(docs, with_signatures(stars, nodes), width, min_percent, scratch, "stars")
    labels = scratch.save(components(star_links, scratch, "star_components"), "star_labels")
    rest = scratch.save(bucket_rest(members, labels, nodes), "rest")
    scratch.release()
    likeliest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest_links = confirm(docs, likeliest, width, min_percent, scratch, "rest")
    links = star_links.union(rest_links)
    # Where the likeliest partner wasn't similar and there are more, the whole component is compared.
    joined = scratch.save(components(links, scratch, "rest_components"), "rest_labels")
    label = lambda c: joined.select(F.col("node").alias(c), F.col("component").alias(f"{c}_now"))
    unsure = rest.where("n > 1").select("a", "c").join(label("a"), "a", "left").join(label("c"), "c", "left")
    unsure = scratch.save(unsure.where(F.coalesce("a_now", "a") != F.coalesce("c_now", "c")).select("a", "c"), "unsure")
    # Most tables leave none, and then the components are known.
    if unsure.isEmpty():
        labels = joined
    else:
        links = links.union(join_components(docs, unsure, labels, nodes, width, min_percent, scratch))
        labels = components(links, scratch, "all_components")

    classes = nodes.select("digest", "node").join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    classes = scratch.save(classes, "classes")
    result = sketched.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(classes, "digest", "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id"))
    result = result.select("doc_id", "n_shingles", component.alias("component_id"))
    result = scratch.save(result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "result")
    scratch.drop("sketches", "nodes", "buckets", "members", "stars_pairs", "stars_links", "star_labels", "rest")
    scratch.drop("rest_pairs", "rest_links", "rest_labels", "unsure", "join_links", "classes")
    return result


def keep_one(docs: DataFrame, width: int = 5, min_percent: int = MIN_PERCENT, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates."""
    scratch = scratch or Scratch(docs.sparkSession)
    verdicts = near_duplicates(docs, width, min_percent, scratch)
    gone = verdicts.where(~F.col("kept")).select("doc_id").distinct()
    return lookup_join(docs, gone, ["doc_id"], None, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
