"""Exact deduplication with an extendible-hash index on shared files (DataFrame operations only).

1. One scan writes an *entry* per row to the shared folder: 64-bit key, normalised text (white space deleted), its
   SHA-256, the pages of 4 KB it fills, the code points of the original, and the caller's columns.
2. The directory doubles from one bucket: a histogram of the leading key bits (``2**MAX_DEPTH`` rows at most, about 32 a
   bucket) tells which buckets hold more than ``capacity`` pages; those split on their next bit.  A bucket that is still
   overfull at the last bit - many copies of one text share a whole key - keeps an overflow chain.
3. Owner tasks take ranges of the key space, whole buckets of about equal pages together: the directory names a row's
   bucket and owner, and the entries go to that task and no other.  Within a bucket equal keys form a chain whose links are
   told apart by comparing the bytes of the normalised texts (grouping on key *and* text).  The entries of overflow chains
   stay where they are until copies have collapsed, so a group with a third of all rows sends one row per map task.
4. Of equal texts the entry with the most code points, then the smallest id, then the first stored row stays.

Defined cases: null text counts as empty, and empty texts (or texts of white space alone) are equal to each other; a
null id sorts after every other id; repeated rows (same id, same text) are members like any other and exactly one of them
stays; an empty table gives an empty result; the caller's column names are kept apart from the entry's own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulastar.llm.joins import join_groups
from aulastar.llm.store import stored

PAGE_BYTES = 4096   # of normalised text; an entry fills one page at least
CAPACITY = 1 << 14  # pages a bucket holds before it splits: 64 MB
SHARES = 1 << 16    # a bucket may always hold this part of all pages: the directory is bounded whatever the input
FINER = 4           # bits by which a bucket may split beyond the average bucket
MAX_DEPTH = 20      # directory of at most 1,048,576 slots
OWNERS = 1 << 15    # tasks that own buckets, at most
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


@dataclass(frozen=True)
class Bucket:
    prefix: int
    depth: int
    entries: int


def split_buckets(histogram: dict[int, int], capacity: int, max_depth: int = MAX_DEPTH) -> list[Bucket]:
    """Buckets of the directory.  ``histogram``: entries by the ``max_depth`` leading key bits."""
    todo, done = [(0, 0, histogram)], []
    while todo:
        prefix, depth, part = todo.pop()
        total = sum(part.values())
        if total <= capacity or depth == max_depth:
            done.append(Bucket(prefix, depth, total))
            continue
        bit = max_depth - depth - 1
        for side in (0, 1):
            todo.append((prefix * 2 + side, depth + 1, {k: n for k, n in part.items() if (k >> bit) & 1 == side}))
    return sorted(done, key=lambda b: b.prefix << (max_depth - b.depth))


def directory_depth(pages: int, capacity: int) -> int:
    """Leading key bits that the histogram tells apart."""
    return min(MAX_DEPTH, (pages // capacity).bit_length() + FINER) if pages > capacity else 0


def owners(buckets: list[Bucket], capacity: int) -> list[int | None]:
    """The owner task of every bucket: ranges of the key space of about equal pages; None for overflow chains."""
    load = sum(b.entries for b in buckets if b.entries <= capacity)
    tasks = max(1, min(OWNERS, sum(b.entries <= capacity for b in buckets)))
    out, before = [], 0
    for b in buckets:
        out.append(before * tasks // load if b.entries <= capacity and load else None if b.entries > capacity else 0)
        before += b.entries if b.entries <= capacity else 0
    return [o if o is None else min(o, tasks - 1) for o in out]


def directory(spark: SparkSession, buckets: list[Bucket], max_depth: int = MAX_DEPTH, capacity: int = CAPACITY) -> DataFrame:
    """Slot -> bucket and owner for the directory's ``2**global depth`` slots, at most ``2**max_depth`` rows."""
    depth = max(b.depth for b in buckets)
    rows = [(b.prefix << (depth - b.depth), 1 << (depth - b.depth), n, b.depth, o) for n, (b, o) in enumerate(zip(buckets, owners(buckets, capacity), strict=True))]
    first = spark.createDataFrame(rows, "slot int, slots int, bucket int, local_depth int, owner int")
    return first.select(F.explode(F.sequence("slot", F.col("slot") + F.col("slots") - 1)).alias("slot"), "bucket", "local_depth", "owner")


def normalised(text):
    out = F.coalesce(text, F.lit(""))
    for c in BLANKS:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _lead(depth: int):
    """The leading bits of the key: the slot in a directory of that depth."""
    return (F.shiftrightunsigned("_key", 64 - depth) if depth else F.lit(0)).cast("int")


class ExactIndex:
    """The index over ``docs``; ``members()`` has one row per document, ``survivors()`` the rows that stay."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 carry: list[str] | None = None):
        self.spark, self.carry = docs.sparkSession, list(carry or [])
        t = F.col(text_col)
        own = [F.col(id_col).alias("_id"), normalised(t).alias("_norm"), F.length(F.coalesce(t, F.lit(""))).cast("long").alias("_points"),
               F.monotonically_increasing_id().alias("_row")]
        kept = F.struct(*[F.col(f"`{c}`") for c in self.carry]) if self.carry else F.lit(None).cast("string")
        entries = docs.select(*own, kept.alias("_carry")).withColumns({
            "_key": F.xxhash64("_norm"), "_sha": F.sha2("_norm", 256), "_pages": F.greatest(F.lit(1), F.ceil(F.octet_length("_norm") / PAGE_BYTES)).cast("int")})
        self.entries = stored(entries, "exact-entries")
        size = self.entries.agg(F.count(F.lit(1)).alias("n"), F.sum("_pages").alias("pages")).first()
        self.total, pages = size["n"], size["pages"] or 0
        self.capacity = max(capacity, pages // SHARES)
        depth = directory_depth(pages, self.capacity)
        lead = _lead(depth)
        histogram = {r["k"]: r["n"] for r in self.entries.groupBy(lead.alias("k")).agg(F.sum("_pages").alias("n")).collect()} if depth else {0: pages}  # 2**MAX_DEPTH rows at most
        self.buckets = split_buckets(histogram, self.capacity, depth)
        self.links = stored(self._links(), "exact-links")

    def _links(self) -> DataFrame:
        """Chain links (distinct texts) with two or more members, and the member that stays."""
        chain = ["bucket", "local_depth", "_key", "_norm", "_sha"]
        slots = directory(self.spark, self.buckets, capacity=self.capacity)
        texts = self.entries.select(_lead(max(b.depth for b in self.buckets)).alias("slot"), "_key", "_norm", "_sha")
        tasks = 1 + max((o for o in owners(self.buckets, self.capacity) if o is not None), default=0)
        owned = texts.join(F.broadcast(slots.filter("owner IS NOT NULL")), "slot")   # 2**MAX_DEPTH rows at most
        texts_seen = owned.repartitionById(tasks, "owner").groupBy("owner", *chain).agg(F.count(F.lit(1)).alias("size")).drop("owner")
        if any(b.entries > self.capacity for b in self.buckets):
            over = texts.join(F.broadcast(slots.filter("owner IS NULL")), "slot").groupBy(*chain).agg(F.count(F.lit(1)).alias("size"))
            texts_seen = texts_seen.unionByName(over)
        texts = texts_seen.filter("size > 1").drop("_norm")
        last = F.struct(F.col("_points"), F.col("_id").isNotNull().alias("has"), (-F.col("_id").cast("decimal(20,0)")).alias("neg"), (-F.col("_row")).alias("row"), F.col("_id").alias("id"))
        stays = self.entries.groupBy("_key", "_sha").agg(F.max(last).alias("m"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        return texts.join(stays, ["_key", "_sha"]).select("bucket", "local_depth", "_key", "_sha", "size", F.col("m.id").alias("keep"), (-F.col("m.row")).alias("keep_row"))

    def _joined(self) -> DataFrame:
        return join_groups(self.entries.select("_key", "_sha", "_id", "_row"), self.links, ["_key", "_sha"], "size", self.total)

    def members(self) -> DataFrame:
        single = F.col("keep_row").isNull()
        return self._joined().select(
            F.col("_id").alias("doc_id"), F.when(single, F.col("_id")).otherwise(F.col("keep")).alias("keep_id"),
            F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
            (single | (F.col("_row") == F.col("keep_row"))).alias("kept"), F.col("_sha").alias("text_sha256"))

    def survivors(self) -> DataFrame:
        """The carried columns of the rows that stay."""
        losers = self._joined().filter(F.col("keep_row").isNotNull() & (F.col("_row") != F.col("keep_row"))).select("_row")
        return self.entries.join(losers, "_row", "left_anti").select("_carry.*")


def exact_dedup(docs: DataFrame, **options) -> DataFrame:
    return ExactIndex(docs, **options).members()
