"""Exact dedup through a cuckoo-filter index of live digests.

Digests are dealt over buckets. Each bucket has a cuckoo filter (rows of four slots with 16-bit
fingerprints) and its content: the 64-bit digest of each live text, the SHA-256 of the whole text, the id
that stays and the number of copies. Every arriving digest asks the filter first. A miss is a new text and
goes in without a look at the content; a hit is verified against the content by SHA-256, so that neither
a fingerprint nor a digest that two texts share ever merges them, and then adds its copies to the entry.
When an insertion finds no place, the filter doubles and is refilled from the stored digests.

Copies are added up within each Arrow batch before the shuffle, so of a text with a third of all rows a
bucket gets one row a batch. A stored index has one more table, ``members``: the rows that each text has
under each id, from which a deletion restores the next largest id. Both tables are files by bucket, and an
update reads and writes the buckets of its batch alone. When the index outgrows its buckets they are split one after
the other (linear hashing), each from its own stored digests.

Defined cases: a null text counts as the empty text; a null ``doc_id`` loses against any other id;
rows that repeat id and text are counted one by one; deleting a row that is not there changes nothing;
an empty table gives an empty result; columns beside ``doc_id`` and ``text`` are ignored and may have
any name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarryline.llm.shared import bounded, cut, shuffle_partitions
from quarryline.operators.snapshots import shared_dir

#: Stored keys that one bucket should hold.
BUCKET_KEYS = 50_000
SLOTS = 4

#: One row a live text, and one a bucket that has its filter and what the filter was asked.
_ENTRIES = "bucket int, digest long, content binary, keep_id {kind}, size long, filter binary, keys long, hits long, misses long, resizes long"
_MEMBERS = "bucket int, digest long, content binary, doc_id {kind}, n long"


class CuckooFilter:
    """Fingerprints of digests in buckets of four slots, with two possible buckets each."""

    def __init__(self, n_buckets: int) -> None:
        self.mask = n_buckets - 1
        self.rows = [[0] * SLOTS for _ in range(n_buckets)]

    @staticmethod
    def parts(digest: int) -> tuple[int, int]:
        """A fingerprint that is never 0, and a hash for the first bucket."""
        return digest & 0xFFFF or 1, digest >> 16

    def other(self, at: int, mark: int) -> int:
        return (at ^ (mark * 0x5BD1E995)) & self.mask

    def contains(self, digest: int) -> bool:
        mark, h = self.parts(digest)
        at = h & self.mask
        return mark in self.rows[at] or mark in self.rows[self.other(at, mark)]

    def insert(self, digest: int) -> bool:
        """False if the digest found no place: the caller must then resize."""
        mark, h = self.parts(digest)
        at = h & self.mask
        for row in (self.rows[at], self.rows[self.other(at, mark)]):
            if 0 in row:
                row[row.index(0)] = mark
                return True
        for step in range(200):
            row = self.rows[at]
            slot = step % SLOTS
            mark, row[slot] = row[slot], mark
            at = self.other(at, mark)
            if 0 in self.rows[at]:
                self.rows[at][self.rows[at].index(0)] = mark
                return True
        return False

    def delete(self, digest: int) -> bool:
        mark, h = self.parts(digest)
        at = h & self.mask
        for row in (self.rows[at], self.rows[self.other(at, mark)]):
            if mark in row:
                row[row.index(mark)] = 0
                return True
        return False

    def tobytes(self) -> bytes:
        return np.array(self.rows, np.uint16).tobytes()

    @classmethod
    def frombytes(cls, data: bytes) -> CuckooFilter:
        rows = np.frombuffer(data, np.uint16).reshape(-1, SLOTS)
        out = cls(len(rows))
        out.rows = rows.tolist()
        return out


class LiveDigests:
    """One bucket of the index: its filter, and its content by digest."""

    def __init__(self) -> None:
        self.filter = CuckooFilter(64)
        #: digest -> entries [SHA-256, id that stays, copies]; two texts of one digest are two entries
        self.keys: dict[int, list[list]] = {}
        self.hits = self.misses = self.resizes = 0

    def _place(self, digest: int) -> None:
        if self.filter.insert(digest):
            return
        while True:  # overflow: a larger filter, filled from the stored digests
            self.resizes += 1
            self.filter = CuckooFilter(2 * (self.filter.mask + 1))
            if all(self.filter.insert(k) for k, held in self.keys.items() for _ in held) and self.filter.insert(digest):
                return

    def find(self, digest: int, content: bytes) -> list | None:
        """The entry of this very text; the content is only looked at after a hit of the filter."""
        if not self.filter.contains(digest):
            self.misses += 1
            return None
        self.hits += 1
        return next((e for e in self.keys.get(digest, ()) if e[0] == content), None)

    def add(self, digest: int, content: bytes, keep_id, size: int) -> None:
        """``size`` more copies of a text, of which ``keep_id`` is the largest id."""
        entry = self.find(digest, content)
        if entry is None:
            self._place(digest)
            self.keys.setdefault(digest, []).append([content, keep_id, size])
        else:
            entry[1] = keep_id if entry[1] is None else entry[1] if keep_id is None else max(entry[1], keep_id)
            entry[2] += size

    def put(self, digest: int, content: bytes, keep_id, size: int) -> None:
        """States a text's id and copies anew; without copies it dies."""
        entry = self.find(digest, content)
        if entry is None:
            if size:
                self._place(digest)
                self.keys.setdefault(digest, []).append([content, keep_id, size])
        elif size:
            entry[1:] = keep_id, size
        else:
            self.keys[digest].remove(entry)
            if not self.keys[digest]:
                del self.keys[digest]
            self.filter.delete(digest)

    def rows(self, bucket: int, kind: pa.DataType) -> pa.Table:
        """The content, one row a text, and the filter's row."""
        flat = [(bucket, _signed(k), *e, *[None] * 5) for k, held in self.keys.items() for e in held]
        flat.append((bucket, None, None, None, None, self.filter.tobytes(), len(flat), self.hits, self.misses, self.resizes))
        types = [pa.int32(), pa.int64(), pa.binary(), kind, pa.int64(), pa.binary(), *[pa.int64()] * 4]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*flat), types)], names=[f.split()[0] for f in _ENTRIES.split(", ")])

    @classmethod
    def load(cls, rows: pa.Table) -> LiveDigests:
        """A bucket again from its rows."""
        out = cls()
        for digest, content, keep_id, size, own in _listed(rows, "digest", "content", "keep_id", "size", "filter"):
            if own is not None:
                out.filter = CuckooFilter.frombytes(own)
            else:
                out.keys.setdefault(digest & _MASK, []).append([content, keep_id, size])
        return out


def _listed(rows: pa.Table, *names: str) -> Iterator[tuple]:
    return zip(*(rows.column(n).to_pylist() for n in names))


_MASK = (1 << 64) - 1


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (64 bits), content (SHA-256) of each row's whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("digest"), F.unhex(F.sha2(text, 256)).alias("content"))


def bucket_count(n_rows: int, spark: SparkSession) -> int:
    return max(shuffle_partitions(spark), -(-n_rows // BUCKET_KEYS))


def bucket_of(digest: str, n_buckets: int) -> Column:
    """The bucket of a digest by linear hashing: with one bucket more, one bucket's digests are dealt over two."""
    h = F.xxhash64(F.lit("bucket"), digest)
    low = 1 << (n_buckets.bit_length() - 1)
    wide, narrow = h.bitwiseAND(2 * low - 1), h.bitwiseAND(low - 1)
    return F.when(wide < n_buckets, wide).otherwise(narrow).cast("int")


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def arrivals(docs: DataFrame) -> DataFrame:
    """digest, content, keep_id, size: the texts of each Arrow batch with their copies added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list] = {}
            for i, digest, content in zip(*(c.to_pylist() for c in batch.columns)):
                e = held.setdefault(content, [digest, content, i, 0])
                e[2] = i if e[2] is None else e[2] if i is None else max(e[2], i)
                e[3] += 1
            columns = list(zip(*held.values())) if held else [()] * 4
            types = [pa.int64(), pa.binary(), batch.schema.field(0).type, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["digest", "content", "keep_id", "size"])

    return digests(bounded(docs)).mapInArrow(run, f"digest long, content binary, keep_id {_kind(docs)}, size long")


def _fill(key: tuple, rows: pa.Table) -> pa.Table:
    """A bucket of arrivals."""
    live = LiveDigests()
    for digest, content, keep_id, size in _listed(rows, "digest", "content", "keep_id", "size"):
        live.add(digest & _MASK, content, keep_id, size)
    return live.rows(key[0].as_py(), rows.schema.field("keep_id").type)


def _restate(key: tuple, old: pa.Table, states: pa.Table) -> pa.Table:
    """A stored bucket after its texts of a batch have been stated anew."""
    live = LiveDigests.load(old)
    for digest, content, keep_id, size in _listed(states, "digest", "content", "keep_id", "size"):
        live.put(digest & _MASK, content, keep_id, size)
    return live.rows(key[0].as_py(), states.schema.field("keep_id").type)


def _built(docs: DataFrame, n_buckets: int) -> DataFrame:
    rows = arrivals(docs).withColumn("bucket", bucket_of("digest", n_buckets))
    return rows.groupBy("bucket").applyInArrow(_fill, _ENTRIES.format(kind=_kind(docs)))


def live(docs: DataFrame) -> DataFrame:
    """content, keep_id, group_size of each distinct text of ``docs``."""
    return entries(_built(docs, bucket_count(docs.count(), docs.sparkSession)))


def entries(rows: DataFrame) -> DataFrame:
    """content, keep_id, group_size of each live text of some buckets' rows."""
    return rows.where("content is not null").select("content", "keep_id", F.col("size").alias("group_size"))


@dataclass
class Index:
    """A stored index: which folder has which bucket's files, and each bucket's number of texts."""

    spark: SparkSession
    kind: str
    n_buckets: int
    folders: dict[int, str] = field(default_factory=dict)
    keys: dict[int, int] = field(default_factory=dict)

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        """``entries`` or ``members`` of all or some buckets; files of others are not read."""
        schema = (_ENTRIES if table == "entries" else _MEMBERS).format(kind=self.kind)
        by_folder: dict[str, list[int]] = {}
        for b, folder in self.folders.items():
            if buckets is None or b in set(buckets):
                by_folder.setdefault(folder, []).append(b)
        out = self.spark.createDataFrame([], schema)
        for folder, held in by_folder.items():
            out = out.unionByName(self.spark.read.schema(schema).parquet(f"{folder}/{table}").where(F.col("bucket").isin(held)))
        return out

    def stored(self, members: DataFrame, rows: DataFrame, gone: list[int]) -> Index:
        """The index with these buckets written beside the old files; buckets in ``gone`` that are not among them are empty."""
        folder = f"{shared_dir(self.spark)}/index-{uuid.uuid4().hex}"
        for table, df in (("members", members), ("entries", rows)):
            df.write.partitionBy("bucket").parquet(f"{folder}/{table}")
        schema = _ENTRIES.format(kind=self.kind)
        written = self.spark.read.schema(schema).parquet(f"{folder}/entries").where("filter is not null")
        keys = {r.bucket: r["keys"] for r in written.select("bucket", "keys").collect()}  # one row a bucket
        kept = {b: f for b, f in self.folders.items() if b not in set(gone)}
        return replace(self, folders=kept | dict.fromkeys(keys, folder), keys={b: self.keys[b] for b in kept} | keys)


def _by_bucket(df: DataFrame) -> DataFrame:
    return df.repartition("bucket")


def build_index(docs: DataFrame, n_buckets: int | None = None) -> Index:
    """A new index of ``docs``; its tables are written to the shared folder."""
    n = n_buckets or bucket_count(docs.count(), docs.sparkSession)
    members = digests(docs).groupBy("digest", "content", "doc_id").agg(F.count(F.lit(1)).alias("n")).withColumn("bucket", bucket_of("digest", n))
    return Index(docs.sparkSession, _kind(docs), n).stored(_by_bucket(members), _built(docs, n), [])


def update_index(index: Index, insert: DataFrame | None = None, delete: DataFrame | None = None, bucket_keys: int = BUCKET_KEYS) -> Index:
    """The index after deleting, then inserting batches of documents (doc_id, text).

    Only the batch's buckets are read and written, and only its texts are stated anew: their largest id that
    is left and their copies.
    """
    changes = None
    for docs, name in ((delete, "gone"), (insert, "new")):
        if docs is not None:
            some = digests(docs).groupBy("digest", "content", "doc_id").agg(F.count(F.lit(1)).alias(name))
            changes = some if changes is None else changes.unionByName(some, allowMissingColumns=True)
    if changes is None:
        return index
    for name in ("gone", "new"):
        changes = changes if name in changes.columns else changes.withColumn(name, F.lit(0).cast("long"))
    changes = cut(changes.withColumn("bucket", bucket_of("digest", index.n_buckets)), "changes")
    touched = [r.bucket for r in changes.select("bucket").distinct().collect()]  # numbers of buckets
    merged = index.read("members", touched).withColumnRenamed("n", "old").unionByName(changes, allowMissingColumns=True)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    count = (F.greatest(total("old") - total("gone"), F.lit(0)) + total("new")).alias("n")
    left = merged.groupBy("bucket", "digest", "content", "doc_id").agg(count)
    members = cut(left.where("n > 0"), "members")
    of = ["bucket", "digest", "content"]
    some = changes.select(*of).distinct()
    none = some.select(*of, F.lit(None).cast(index.kind).alias("doc_id"), F.lit(0).cast("long").alias("n"))
    states = members.join(some, of, "left_semi").unionByName(none).groupBy(*of).agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("size"))
    rows = index.read("entries", touched).groupBy("bucket").cogroup(states.groupBy("bucket")).applyInArrow(_restate, _ENTRIES.format(kind=index.kind))
    out = index.stored(_by_bucket(members), rows, touched)
    wanted = -(-sum(out.keys.values()) // bucket_keys)
    return split(out, wanted) if wanted > out.n_buckets else out


def split(index: Index, n_buckets: int) -> Index:
    """The index with more buckets; only those whose digests part are read, and their filters are filled from the stored digests."""

    def origin(b: int) -> int:
        while b >= index.n_buckets:
            b -= 1 << (b.bit_length() - 1)
        return b

    parted = sorted({origin(b) for b in range(index.n_buckets, n_buckets)})
    dealt = lambda table: index.read(table, parted).where("content is not null").withColumn("bucket", bucket_of("digest", n_buckets))
    members = dealt("members")
    rows = dealt("entries").groupBy("bucket").applyInArrow(_fill, _ENTRIES.format(kind=index.kind))
    return replace(index.stored(_by_bucket(members), rows, parted), n_buckets=n_buckets)


def lookup(index: Index, docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size of the rows of ``docs`` whose text is live.

    The filters come first: a row that misses goes no further, and only hits meet the stored content.
    """
    rows = digests(docs).withColumn("bucket", bucket_of("digest", index.n_buckets))
    filters = index.read("entries").where("filter is not null").select("bucket", "filter")

    def ask(key: tuple, rows: pa.Table, own: pa.Table) -> pa.Table:
        if not own.num_rows:
            return rows.slice(0, 0)
        held = CuckooFilter.frombytes(own.column("filter")[0].as_py())
        return rows.filter(pa.array([held.contains(d & _MASK) for d in rows.column("digest").to_pylist()], pa.bool_()))

    schema = f"doc_id {_kind(docs)}, digest long, content binary, bucket int"
    hits = rows.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(ask, schema)
    content = index.read("entries").where("content is not null").select("bucket", "digest", "content", "keep_id", F.col("size").alias("group_size"))
    return hits.join(content, ["bucket", "digest", "content"]).select("doc_id", "keep_id", "group_size")


def duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Of equal texts the largest doc_id stays (``kept``); rows that repeat that id are all marked kept.
    The join's hot texts are split by Spark's adaptive skew join.
    """
    joined = digests(docs).join(live(docs), "content")
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("content")).alias("text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per text, with all its columns: that of the largest doc_id.

    Whole rows are shuffled once, by text and id; the ids that stay come from the index of digests.
    """
    names = ["content", "of", "place"]
    while any(n in docs.columns for n in names):
        names = [f"_{n}" for n in names]
    content, of, place = names
    name_of = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    groups = live(docs).select(F.col("content").alias(content), name_of("keep_id").alias(of))
    keyed = docs.withColumns({content: F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)), of: name_of("doc_id")})
    # the join leaves the rows dealt by text and id; of rows that repeat both, one stays
    first = Window.partitionBy(content, of).orderBy(content)
    kept = keyed.join(groups, [content, of], "left_semi").withColumn(place, F.row_number().over(first))
    return kept.where(F.col(place) == 1).select(*docs.columns)
