"""Phrase collocations by direct-address tiling, in every language on its own.

A first pass turns texts into blocks of word ids. Ids are dealt by a block's own word frequencies, commonest first, so pairs of
common words fall into few square tiles of the pair table. A tile with enough pairs is counted in a dense array by ``np.bincount``;
the pairs of all other tiles are counted together as sorted coordinates (COO). Pairs that may be frequent get ids in their
turn, again by frequency, and pairs of neighbouring pairs are the phrases of three words; so on up to ``LONGEST`` words.

Blocks are counted apart and their counts summed by phrase, so that no vocabulary is ever held in one place. Between passes over the
blocks the frequent phrases become a Bloom filter of fixed size (``FILTER_BITS``), which keeps phrases with an infrequent part from
being counted. Phrases that it lets through by mistake cost time only, since counts are always exact.

Most pairs are rare, so the first pass sums pairs by 40 bits of their hash, packed in rows by the leading bits, a count being cut at MIN_COUNT. A
hash below it has no frequent pair, so the second pass counts the pairs of the others, by name, with the phrases of three words. The third
counts those of four and five words.

Score of a cut: floor(1000 * a * n / (l * r)) in decimals of 38 digits. A phrase takes its lowest cut, the smallest on ties.

Defined results: a null text is empty; a null language is ``und``; repeated rows count as often as they stand; ids don't
matter; extra columns stay out; an empty table, or one without a frequent phrase, gives an empty table. A very long text is read in slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanforge.llm.common import SALTS, Scratch, salted, slices, text_batches

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
# Words of a block, at least; a block ends with a text.
BLOCK_WORDS = 1 << 17
# Phrases handed on at a time, and blocks that a reader holds.
OUT_ROWS = 20_000
BLOCKS_READ = 64
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
# Ids on a tile's side; pairs that a tile must hold to be counted densely.
TILE = 256
DENSE = TILE * TILE // 16
# Tiles on a side of the table that may be dense, and tiles counted in one array of 16 MiB. Rarer ids are in sparse tiles.
SIDE, TILES_AT_ONCE = 1024, 32
# Bits of the filter of frequent phrases: 8 MiB whatever the corpus.
FILTER_BITS = 1 << 26
# Filters and sums by hash use the leading 40 bits of a hash, sums in groups by the first 12 of them.
SPARE_BITS, PART_BITS = 24, 28
# Counts that a task merges before it hands them on.
MERGED = 1 << 21

GAP = b"\n"
# Bytes of a text: A-Z in lower case, a tab as a blank, ends of pieces as a gap. All of them are single bytes in UTF-8.
_CHANGED = {9: 32, **{i: i + 32 for i in range(65, 91)}, **dict.fromkeys(b".,;:!?\n\x0b\x0c\r", GAP[0])}
TABLE = bytes(_CHANGED.get(i, i) for i in range(256))


class Ids(dict):
    """Ids in order of first sight. 0 is no word, 1 a gap."""

    def __init__(self):
        super().__init__({b"": 0, GAP: 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = new = len(self)
        return new


def codes_of(text: str, ids: Ids) -> np.ndarray:
    """Ids of a text's words, with 1 between pieces and at the end."""
    data = text.encode().translate(TABLE)
    parts = [np.fromiter(map(ids.__getitem__, words), np.int32, len(words)) for words in (s.replace(GAP, b" \n ").split(b" ") for s in slices(data))]
    codes = np.concatenate([*parts, np.array([1], np.int32)])
    return codes[codes > 0]


def ranked(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes by falling frequency (0 the commonest, -1 where codes are negative), the old codes in that order, and their counts."""
    counts = np.bincount(codes[codes >= 0], minlength=size)
    order = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    rank = np.full(size + 1, -1, np.int64)
    rank[order] = np.arange(len(order))
    return rank[codes], order, counts[order]


BLOCKS = "lang string, codes binary, words array<string>, counts array<bigint>"
BLOCKS_ARROW = pa.schema([("lang", pa.string()), ("codes", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


def encode_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of (lang, text) rows: ranked ids as 32-bit integers (-1 a gap), the words by rank, and their counts."""
    open_: dict[str, tuple[Ids, list[np.ndarray]]] = {}
    held = 0

    def block(lang: str) -> pa.RecordBatch:
        ids, parts = open_.pop(lang)
        codes, order, counts = ranked(np.concatenate(parts) - 2, len(ids) - 2) if len(ids) > 2 else (np.empty(0), np.empty(0, int), np.empty(0, int))
        words = list(ids)[2:]
        named = pa.array([words[i] for i in order], pa.binary()).cast(pa.string())
        columns = [pa.array([lang]), pa.array([codes.astype("<i4").tobytes()], pa.binary()), *[pa.ListArray.from_arrays([0, len(order)], a) for a in (named, pa.array(counts, pa.int64()))]]
        return pa.RecordBatch.from_arrays(columns, schema=BLOCKS_ARROW)

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            ids, parts = open_.setdefault(lang, (Ids(), []))
            parts.append(codes_of(text, ids))
            held += len(parts[-1])
            if held >= BLOCK_WORDS:
                yield from [block(k) for k in list(open_)]
                held = 0
    yield from [block(k) for k in list(open_)]


def count_pairs(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs of ids below ``n`` as left * n + right, ordered, and their counts; ids are ranks, commonest first."""
    keys, counts = [], []
    side = min(SIDE, n // TILE + 1)
    low = (left < side * TILE) & (right < side * TILE)
    tile = np.where(low, (left // TILE) * side + right // TILE, side * side)
    dense = np.flatnonzero(np.bincount(tile, minlength=side * side + 1)[:-1] >= DENSE)
    slot = np.full(side * side + 1, -1)
    slot[dense] = np.arange(len(dense))
    slot = slot[tile]
    for i in range(0, len(dense), TILES_AT_ONCE):
        inside = (slot >= i) & (slot < i + TILES_AT_ONCE)
        cells = np.bincount(((slot[inside] - i) * TILE + left[inside] % TILE) * TILE + right[inside] % TILE)
        at = np.flatnonzero(cells)
        t = dense[i + at // (TILE * TILE)]
        keys.append((t // side * TILE + at // TILE % TILE) * n + t % side * TILE + at % TILE)
        counts.append(cells[at])
    coo = np.sort((left * n + right)[slot < 0])
    first = np.flatnonzero(np.concatenate([[True], coo[1:] != coo[:-1]])) if len(coo) else np.empty(0, np.int64)
    keys, counts = np.concatenate([*keys, coo[first]]), np.concatenate([*counts, np.diff(np.append(first, len(coo)))])
    order = np.argsort(keys, kind="stable")
    return keys[order], counts[order]


def word_hashes(lang: str, words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{lang}\n{w}") for w in words], np.uint64)


def join_hashes(left: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all but its last word, and that of its last word."""
    mixed = (left ^ (last >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + last
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    mask = np.uint64(FILTER_BITS - 1)
    hit = lambda at: (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
    return (hit((hashes >> np.uint64(SPARE_BITS)) & mask) & hit((hashes >> np.uint64(38)) & mask)).astype(bool)


def phrases_of(lang: str, codes: np.ndarray, words: list[str], filters: list[np.ndarray], levels: tuple[int, ...]) -> Iterator[tuple]:
    """Of each of ``levels`` a block's phrases whose parts, and themselves, pass the filters there are: number of words, names by place, hashes, counts.

    ``filters`` are of phrases of 1, 2, ... words.
    """
    first_hashes = word_hashes(lang, words)
    good = np.append(passes(filters[0], first_hashes), False)
    seq, kept, _ = ranked(np.where(good[codes], codes, -1), len(words))
    all_names = np.array(words, object)
    hashes, last, text = first_hashes[kept], kept, all_names[kept]
    for level in range(2, levels[-1] + 1):
        n = max(1, len(hashes))
        at = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
        keys, counts = count_pairs(seq[at], seq[at + 1], n)
        # Of each phrase: the one without its last word, and that word.
        left, last = keys // n, last[keys % n]
        hashes = join_hashes(hashes[left], first_hashes[last])
        good = passes(filters[level - 1], hashes) if level <= len(filters) else np.ones(len(hashes), bool)
        if level in levels:
            mine = np.flatnonzero(good)
            yield level, lambda i, text=text, left=left[mine], last=last[mine]: text[left[i]] + " " + all_names[last[i]], hashes[mine], counts[mine]
        if level < levels[-1]:
            found = np.full(len(seq), -1, np.int64)
            found[at] = np.searchsorted(keys, seq[at] * n + seq[at + 1])
            seq, order, _ = ranked(np.where(np.append(good, False)[found], found, -1), len(keys))
            left, last, hashes = left[order], last[order], hashes[order]
            text = text[left] + " " + all_names[last] if len(left) else text[:0]


def blocks_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, list[str]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            lang, words = batch.column("lang")[i].as_py(), batch.column("words")[i].as_py()
            if words:
                yield lang, np.frombuffer(batch.column("codes")[i].as_buffer(), "<i4").astype(np.int64), words


PHRASES = "lang string, n_words int, phrase string, hash bigint, n bigint"


def counter(filters, levels: tuple[int, ...], hashed: int):
    """A function over blocks that counts phrases of ``levels`` words; ``filters``: broadcast filters of shorter ones; hashes go along for ``hashed`` words only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [f.value for f in filters]
        for lang, codes, words in blocks_in(batches):
            for level, name, hashes, counts in phrases_of(lang, codes, words, bits, levels):
                for i in range(0, len(hashes), OUT_ROWS):
                    part = slice(i, i + OUT_ROWS)
                    text, own = name(part).tolist(), hashes[part].view(np.int64) if level == hashed else np.zeros(len(hashes[part]), np.int64)
                    columns = [pa.array([lang] * len(text), pa.string()), pa.array([level] * len(text), pa.int32()), pa.array(text, pa.string()), pa.array(own), pa.array(counts[part], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "n_words", "phrase", "hash", "n"])

    return count


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order and the sums of their counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def planes(numbers: np.ndarray) -> bytes:
    """Numbers as their first bytes, then their second, ...: like bytes side by side compress."""
    return numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


SUMS = "part int, hashes binary, counts binary"


def pair_hashes(words_filter, least: int):
    """A function over blocks that counts pairs of frequent words by the leading bits of their hashes, up to ``least``, in rows by the first of them."""

    def packed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, counts = summed(*map(np.concatenate, zip(*held)))
        parts, start = np.unique(keys >> np.uint64(PART_BITS), return_index=True)
        rest, counts = (keys & np.uint64((1 << PART_BITS) - 1)).astype("<u4"), np.minimum(counts, least).astype("<u4")
        rows = [slice(a, b) for a, b in zip(start, [*start[1:], len(keys)])]
        columns = [pa.array(parts.astype(np.int32)), *[pa.array([planes(x[r]) for r in rows], pa.binary()) for x in (rest, counts)]]
        return pa.RecordBatch.from_arrays(columns, ["part", "hashes", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for lang, codes, words in blocks_in(batches):
            for _, _, hashes, counts in phrases_of(lang, codes, words, [words_filter.value], (2,)):
                held.append((hashes >> np.uint64(SPARE_BITS), counts))
                size += len(hashes)
            if size >= MERGED:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    return count


def frequent_hashes(least: int):
    """A function over the rows of one part: hashes, the bits that weren't kept being 0, whose counts reach ``least``."""

    def frequent(table: pa.Table) -> pa.Table:
        keys, counts = (np.concatenate([from_planes(x, "<u4") for x in table[c].to_pylist()]) for c in ("hashes", "counts"))
        keys, counts = summed(keys, counts.astype(np.int64))
        full = (np.uint64(table["part"][0].as_py()) << np.uint64(PART_BITS)) + keys[counts >= least].astype(np.uint64)
        return pa.table({"hash": pa.array((full << np.uint64(SPARE_BITS)).view(np.int64))})

    return frequent


def hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the hash of a single word."""
    for batch in batches:
        hashes = [word_hashes(lang, [w])[0] for lang, w in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())]
        columns = [batch.column("lang"), pa.array([1] * batch.num_rows, pa.int32()), batch.column("phrase"), pa.array(np.array(hashes, np.uint64).view(np.int64)), batch.column("n")]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "n_words", "phrase", "hash", "n"])


def filter_of(frequent: DataFrame) -> np.ndarray:
    """Bits of the hashes: at most FILTER_BITS / 64 numbers reach the driver, however many phrases there are."""
    mask = F.lit(FILTER_BITS - 1)
    places = frequent.select(F.explode(F.array(*[F.shiftrightunsigned("hash", bits).bitwiseAND(mask) for bits in (SPARE_BITS, 38)])).alias("at"))
    cells = places.select(F.shiftright("at", 6).alias("cell"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for batch in cells.toArrow().to_batches():
        bits[batch.column("cell").to_numpy()] = batch.column("bits").to_numpy()
    return bits.view(np.uint64)


def count_phrases(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of all words, and (lang, n_words, phrase, f) of every phrase of 1 to LONGEST words that stands MIN_COUNT times."""
    spark = docs.sparkSession
    text_batches(spark)
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where(F.col("text").isNotNull())
    blocks = scratch.save(rows.mapInArrow(encode_blocks, BLOCKS), "blocks")
    batch_size = spark.conf.get(READ_ROWS)
    spark.conf.set(READ_ROWS, BLOCKS_READ)
    totals = blocks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, x: s + x)).alias("n"))
    words = blocks.select("lang", F.explode(F.arrays_zip(F.col("words").alias("phrase"), F.col("counts").alias("n"))).alias("w")).groupBy("lang", F.col("w.phrase").alias("phrase"))
    frequent = words.agg(F.sum("w.n").alias("n")).where(F.col("n") >= MIN_COUNT).mapInArrow(hash_words, PHRASES)
    share = lambda frequent: spark.sparkContext.broadcast(filter_of(frequent))
    frequent = scratch.save(frequent, "phrases_1")
    filters = [share(frequent)]
    sums = blocks.select("lang", "codes", "words").mapInArrow(pair_hashes(filters[0], MIN_COUNT), SUMS)
    filters.append(share(scratch.save(sums.groupBy("part").applyInArrow(frequent_hashes(MIN_COUNT), "hash bigint"), "hashes_2")))
    own = lambda df: df.select("lang", "n_words", "phrase", F.col("n").alias("f"))
    found = own(frequent)
    for levels in ((2, 3), (4, LONGEST)):
        counted = blocks.select("lang", "codes", "words").mapInArrow(counter(filters, levels, levels[0] + 1 if levels[-1] < LONGEST else 0), PHRASES)
        counted = counted.groupBy("lang", "n_words", "phrase").agg(F.min("hash").alias("hash"), F.sum("n").alias("n"))
        counted = scratch.save(counted.where(F.col("n") >= MIN_COUNT), f"phrases_{levels[-1]}")
        found = found.unionByName(own(counted))
        if levels[-1] < LONGEST:
            filters.append(share(counted.where(F.col("n_words") == levels[-1])))
    totals = scratch.save(totals, "totals")
    spark.conf.set(READ_ROWS, batch_size)
    found = scratch.save(found, "phrases")
    scratch.drop("blocks", "hashes_2", "phrases_1", "phrases_3", f"phrases_{LONGEST}")
    return totals, found


def collocations(docs: DataFrame) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's TOP phrases of ``docs`` (lang, text)."""
    scratch = Scratch(docs.sparkSession)
    totals, found = count_phrases(docs, scratch)
    long = found.where("n_words > 1")
    # A longer phrase as frequent as one inside it implies one that is longer by a single word.
    inside = lambda pattern: long.where("n_words > 2").select("lang", F.regexp_replace("phrase", pattern, "").alias("phrase"), "f")
    covers = inside(r"^[^ ]+ ").union(inside(r" [^ ]+\z")).groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    free = long.join(covers, ["lang", "phrase"], "left").where("cover is null or cover < f").drop("cover")
    words = F.split("phrase", " ")
    cuts = free.withColumn("words", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", F.array_join(F.expr("slice(words, 1, k)"), " ").alias("left"), F.array_join(F.expr("slice(words, k + 1, n_words)"), " ").alias("right"))
    part = lambda name, f: found.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = salted(salted(cuts, part("left", "l"), ["lang", "left"], "right"), part("right", "r"), ["lang", "right"], "left")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    # 1000 * a * n needs at most 38 digits: a <= n, and n^2 * 1000 < 10^38 for n up to 3 * 10^17 words.
    cuts = salted(cuts, totals, ["lang"], "phrase")
    cuts = cuts.withColumn("top", (exact("a") * F.lit(1000).cast("decimal(4,0)") * exact("n")).cast("decimal(38,0)")).withColumn("below", (exact("l") * exact("r")).cast("decimal(38,0)"))
    cuts = cuts.withColumn("score", F.expr("top div below"))
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    best = [F.desc("score"), F.desc("a"), "phrase"]
    # Ranked in parts first, so that a language's last sort holds TOP rows of each part.
    parts = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).where(F.col("rank") <= TOP)
    top = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= TOP)
    return top.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
