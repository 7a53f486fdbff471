"""SimHash near-dedup with bit-sliced comparison.

Fingerprints are 64-bit majority votes over the XXH64 values of a text's word shingles. Equal
fingerprints collapse to one node first. Candidates come from the pigeonhole principle: with
``radius`` differing bits, at least two of four 16-bit parts agree, which gives six keys; a key
with more fingerprints than a block holds is refined by the same rule over the bits that the key
leaves open, so that no group is unbounded and no link is lost. Within a group the bit planes are
stored vertically: one query bit is compared with a whole block by one XOR, distances are counted
by carry-save adders over planes, and a block is left as soon as every distance exceeds the radius.

Defined cases: a null or empty text has fingerprint 0 and links like any other; fewer words than a
shingle make one shingle of all words; rows of a null ``doc_id`` get a fingerprint but no component
(null); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.components import components
from quarryline.llm.rolling import mix, shingle_hashes
from quarryline.llm.shared import bounded, cut, release, sliced

SEED = 42
# The wide sketch of similar_links: lanes of 64 bits, bands of MinHash values, and the radius of candidates
# (39 bits expected at a similarity of 0.8, and 3.7 deviations to spare).
WIDE_WIDTH, LANES, WIDE_RADIUS = 5, 4, 60
#: Least similarity of linked documents, as a fraction of whole numbers.
SIMILAR = (4, 5)
BANDS, BAND_ROWS = 12, 3
LANE_NAMES = [f"l{k}" for k in range(LANES)]
#: Fingerprints that one group may hold before its key is refined.
BLOCK = 4096
#: Shingles of the documents that one group verifies.
GROUP_SHINGLES = 1 << 22
#: Shingles hashed before their bits are added up, and queries that one bit-sliced pass compares.
SHINGLES = 1 << 15
QUERIES = 256


def bit_sums(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How often each bit is set among the hashes of each of ``n`` owners. hashes: (m, lanes) of uint64, grouped by owner.

    Rows are added in bytes first, up to 255 at a time, which is many times faster than in wide numbers.
    """
    sums = np.zeros((n, 64 * hashes.shape[1]), np.int64)
    for at in range(0, len(hashes), SHINGLES):
        part, own = np.ascontiguousarray(hashes[at : at + SHINGLES]), owner[at : at + SHINGLES]
        bits = np.unpackbits(part.view(np.uint8), axis=1, bitorder="little")
        start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]).tolist()
        for a, b in zip(start, [*start[1:], len(own)]):
            for k in range(a, b, 255):
                sums[own[a]] += np.add.reduce(bits[k : min(b, k + 255)], axis=0, dtype=np.uint8)
    return sums


def fingerprint(text: str | None, width: int = 3) -> int:
    """Majority bits of the hashes of all shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(lengths + 1) - 1
    start = end - lengths
    if len(words) > width:
        start, end = start[: 1 - width], end[width - 1 :]
    else:
        start, end = start[:1], end[-1:]
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for k in range(0, len(start), SHINGLES):
        part = np.array([hashed(joined[s:e], SEED) for s, e in zip(start[k : k + SHINGLES].tolist(), end[k : k + SHINGLES].tolist())], np.uint64)
        counts += bit_sums(part[:, None], np.zeros(len(part), np.int64), 1)[0]
    return int(np.packbits(2 * counts > len(start), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of each row."""

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches, 1):
            fps = np.array([fingerprint(t, width) for t in rows.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])
        release()

    return bounded(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(batch, "doc_id long, fp long")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Vertical storage: row p holds bit p of every value, 64 values to a word. values: (n, lanes) of uint64."""
    n = len(values)
    bits = np.zeros((64 * values.shape[1], -(-n // 64) * 64), np.uint8)
    bits[:, :n] = np.unpackbits(np.ascontiguousarray(values).view(np.uint8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def close_pairs(values: np.ndarray, radius: int, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of values of one group that differ in up to ``radius`` bits. values: uint64, or (n, lanes) of it.

    Groups (numbers that lie together; one group by default) fill blocks of lanes whatever their size: a block of
    queries meets a plane of the lanes of all its groups in one XOR, distances are counted by carry-save
    steps into bit slices, and queries whose distances all exceed the radius leave the block. Lanes of other groups
    count as beyond the radius from the start.
    """
    values = values.reshape(len(values), -1)
    n = len(values)
    group = np.zeros(n, np.int64) if group is None else group
    edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    upto = np.repeat(edge[1:], np.diff(edge))  # where each value's group ends
    planes = bit_planes(values)
    bits = np.unpackbits(np.ascontiguousarray(values).view(np.uint8), axis=1, bitorder="little")
    slices = max(1, (radius + 1).bit_length())
    left, right = [], []
    for first in range(0, n, QUERIES):
        query = np.arange(first, min(n, first + QUERIES))
        base, end = first // 64 * 64, int(upto[query[-1]])
        words = planes[:, base // 64 : -(-end // 64)]
        lane = np.arange(base, base + 64 * words.shape[1])
        other = (lane <= query[:, None]) | (lane >= upto[query][:, None])
        over = np.packbits(other, axis=1, bitorder="little").view(np.uint64)  # lanes without a pair, or whose distance left the counters
        order = np.flatnonzero((bits[first:end] != bits[first]).any(axis=0))  # planes in which the block differs at all
        flip = (np.uint64(0) - bits[query].astype(np.uint64)).T  # all ones where the query's bit is set
        counters = [np.zeros((len(query), words.shape[1]), np.uint64) for _ in range(slices)]
        for k, p in enumerate(order):
            carry = words[p][None] ^ flip[p][:, None]
            for c in counters:
                carry, c[:] = c & carry, c ^ carry
            over |= carry
            if k % 16 == 15:
                live = (~(_beyond(counters, radius) | over)).any(axis=1)
                if not live.all():
                    query, flip, over, counters = query[live], flip[:, live], over[live], [c[live] for c in counters]
                    if not len(query):
                        break
        if len(query):
            within = ~(_beyond(counters, radius) | over)
            row, column = np.nonzero(np.unpackbits(within.view(np.uint8), axis=1, bitorder="little"))
            left.append(query[row])
            right.append(column + base)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int), np.zeros(0, int))


def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Bit slice of the lanes whose count is above ``radius``."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def _spanning(left: np.ndarray, right: np.ndarray, n: int) -> list[int]:
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(left.tolist(), right.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def compare_groups(radius: int):
    """For rows (key, node, lanes...) sorted by key: links (a, b) that span each group's close pairs."""

    def linked(key: np.ndarray, ids: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        root = np.array(_spanning(*close_pairs(fps, radius, key), len(key)), np.int64)
        other = np.flatnonzero(root != np.arange(len(key)))
        return pa.RecordBatch.from_arrays([pa.array(ids[other]), pa.array(ids[root[other]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last group of a batch may go on in the next."""
        held: list[np.ndarray] = []
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = [np.concatenate(x) for x in zip(held, new)] if held else new
            last = int(np.argmax(held[0] == held[0][-1])) if len(held[0]) else 0
            if last:
                yield linked(held[0][:last], held[1][:last], np.stack([h[:last] for h in held[2:]], axis=1).view(np.uint64))
                held = [h[last:] for h in held]
        if held and len(held[0]):
            yield linked(held[0], held[1], np.stack(held[2:], axis=1).view(np.uint64))

    return run


def _keys(rows: DataFrame, level: int, radius: int) -> DataFrame:
    """Adds the next level's keys: the open bits are cut into ``radius + 2`` parts, of which two agree.

    ``open`` is the mask of bits that the key so far leaves open; each choice of two parts fixes them.
    """
    parts = radius + 2
    choices = list(combinations(range(parts), 2))

    def subsets(mask: int) -> list[tuple[int, int]]:
        free = [b for b in range(64) if mask >> b & 1]
        pieces = [sum(1 << b for b in free[len(free) * k // parts : len(free) * (k + 1) // parts]) for k in range(parts)]
        return [(pieces[a] | pieces[b], mask & ~(pieces[a] | pieces[b])) for a, b in choices]

    masks = {(): (1 << 64) - 1}
    for _ in range(level):
        masks = {(*path, k): rest for path, mask in masks.items() for k, (_, rest) in enumerate(subsets(mask))}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    table = {path: [(k, signed(fixed)) for k, (fixed, _) in enumerate(subsets(mask))] for path, mask in masks.items()}
    code = lambda path: sum((k + 1) * 16**i for i, k in enumerate(path))
    options = F.create_map(*[x for path, opts in table.items() for x in (F.lit(code(path)), F.array(*[F.struct(F.lit(code((*path, k))).alias("path"), F.lit(m).cast("long").alias("fixed")) for k, m in opts]))])
    return rows.select("fp", "node", F.explode(options[F.col("path")]).alias("o"), F.col("key").alias("above")).select(
        "fp", "node", F.col("o.path").alias("path"), F.xxhash64(F.col("above"), F.col("o.path"), F.col("fp").bitwiseAND(F.col("o.fixed"))).alias("key")
    )


def links(nodes: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between nodes (fp long, node long) that connect what lies within ``radius`` bits.

    Not every pair is listed: each group gives a spanning forest, which has the same components.
    """

    rows = nodes.select("fp", "node", F.lit(0).alias("path"), F.lit(0).cast("long").alias("key"))
    found = None
    for level in range(3):
        keyed = _keys(rows, level, radius)
        sizes = keyed.groupBy("path", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        keyed = keyed.join(sizes, ["path", "key"])
        small = keyed if level == 2 else keyed.where(F.col("n") <= block)
        pairs = small.repartition("key").sortWithinPartitions("key").select("key", "node", "fp").mapInArrow(compare_groups(radius), "a long, b long")
        found = pairs if found is None else found.union(pairs)
        if level < 2:
            rows = cut(keyed.where(F.col("n") > block).select("fp", "node", "path", "key"), "dense")
            if rows.isEmpty():
                break
    return found.distinct()


def fingerprint_links(fps: DataFrame, radius: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (fp, node: the smallest doc_id of each fingerprint) and links (a, b) between doc_ids."""
    known = fps.where("doc_id is not null")
    nodes = known.groupBy("fp").agg(F.min("doc_id").alias("node"))
    # a doc_id that occurs with several texts joins their fingerprints
    same = known.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y").select("doc_id")
    repeated = known.join(same, "doc_id").join(nodes, "fp").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    return nodes, links(nodes, radius, block).union(repeated)


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id that links reach) for every row of ``docs``."""
    fps = cut(fingerprints(docs, width), "fingerprints")
    nodes, linked = fingerprint_links(fps, radius, block)
    named = nodes.join(components(linked), "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return fps.join(named, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def distinct_shingles(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one text after the other, and their counts."""
    hashes, offsets = shingle_hashes([(t or "").encode().lower() for t in texts], width)
    document = np.repeat(np.arange(len(texts)), np.diff(offsets))
    order = np.lexsort((hashes, document))
    hashes, document = hashes[order], document[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (document[1:] != document[:-1])
    return hashes[new], np.bincount(document[new], minlength=len(texts))


def sketch_lanes(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """256-bit SimHash of each text's set of shingles."""
    seeds = np.random.default_rng(SEED).integers(1, 2**63, LANES, dtype=np.uint64)
    if not len(hashes):
        return np.zeros((len(counts), LANES), np.uint64)
    votes = bit_sums(np.stack([mix(hashes ^ s) for s in seeds], axis=1), np.repeat(np.arange(len(counts)), counts), len(counts))
    return np.packbits(2 * votes > counts[:, None], axis=1, bitorder="little").view(np.uint64)


def sketches(docs: DataFrame, width: int = WIDE_WIDTH) -> DataFrame:
    """doc_id, l0..l3 (a 256-bit SimHash over the set of ``width``-word shingles), same (a digest of the set), keys (hashes of MinHash bands)."""
    odd = np.random.default_rng(SEED + 1).integers(1, 2**63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sketch(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, counts = distinct_shingles(texts, width)
        some = np.flatnonzero(counts)
        same = np.zeros(len(texts), np.uint64)
        keys = np.zeros((len(texts), BANDS), np.int64)
        if not len(some):
            return sketch_lanes(hashes, counts), same, keys
        starts = (np.cumsum(counts) - counts)[some]
        same[some] = mix(np.add.reduceat(mix(hashes ^ np.uint64(SEED)), starts) ^ counts[some].astype(np.uint64))
        minima = np.stack([np.minimum.reduceat(hashes * a, starts) for a in odd], axis=1).reshape(len(some), BANDS, BAND_ROWS)
        folded = np.tile(np.arange(BANDS, dtype=np.uint64), (len(some), 1))
        for k in range(BAND_ROWS):
            folded = mix(folded * np.uint64(0x9E3779B97F4A7C15) ^ minima[:, :, k])
        keys[some] = folded.view(np.int64)
        return sketch_lanes(hashes, counts), same, keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches, 1):
            lanes, same, keys = sketch(rows.column(1).to_pylist())
            columns = [rows.column(0), *(pa.array(lanes[:, x].view(np.int64)) for x in range(LANES)), pa.array(same.view(np.int64)), pa.array(list(keys), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *LANE_NAMES, "same", "keys"])
        release()

    schema = f"doc_id long, {', '.join(f'{n} long' for n in LANE_NAMES)}, same long, keys array<long>"
    return bounded(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, width: int = WIDE_WIDTH) -> DataFrame:
    """key, node, l0..l3, shingles (the sorted distinct hashes) of rows (key, node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches, 2):
            hashes, counts = distinct_shingles(rows.column(2).to_pylist(), width)
            lanes = sketch_lanes(hashes, counts)
            sets = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *(pa.array(lanes[:, x].view(np.int64)) for x in range(LANES)), sets], names=["key", "node", *LANE_NAMES, "shingles"])
        release()

    schema = f"key long, node long, {', '.join(f'{n} long' for n in LANE_NAMES)}, shingles array<long>"
    return bounded(docs).select("key", "node", "text").mapInArrow(run, schema)


def verified_links(ids: np.ndarray, values: np.ndarray, sets: list[np.ndarray], radius: int, least: tuple[int, int] = SIMILAR) -> tuple[list[int], list[int]]:
    """Links of exact similarity ``least`` or more that connect whatever such pairs within ``radius`` connect."""
    left, right = close_pairs(values, radius)
    a: list[int] = []
    b: list[int] = []
    if not len(left):
        return a, b
    order = np.argsort(left, kind="stable")
    left, right = left[order], right[order]
    size = np.array([len(s) for s in sets], np.int64)
    dense = np.unique(np.concatenate(sets), return_inverse=True)[1]
    dense = np.split(dense, np.cumsum(size)[:-1])
    mark = np.zeros(int(size.sum()) + 1, bool)
    label = np.arange(len(ids))
    edge = np.flatnonzero(np.r_[True, left[1:] != left[:-1], True])
    for at, to in zip(edge[:-1].tolist(), edge[1:].tolist()):
        i, others = int(left[at]), right[at:to]
        others = others[(label[others] != label[i]) & (np.minimum(size[others], size[i]) * least[1] >= np.maximum(size[others], size[i]) * least[0])]
        if not len(others):
            continue
        mark[dense[i]] = True
        for j in others.tolist():
            if label[j] == label[i]:  # joined by an earlier one
                continue
            common = int(np.count_nonzero(mark[dense[j]]))
            if common * least[1] >= least[0] * int(size[i] + size[j] - common):
                a.append(int(ids[i]))
                b.append(int(ids[j]))
                label[label == label[j]] = label[i]
        mark[dense[i]] = False
    return a, b


def verify_groups(radius: int):
    """For rows (key, node, lanes..., shingles) sorted by key: the verified links of each group."""

    def linked(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids = np.concatenate([r.column(1).to_numpy() for r in rows])
        values = np.concatenate([np.stack([r.column(2 + x).to_numpy() for x in range(LANES)], axis=1) for r in rows]).view(np.uint64)
        sets = [s for r in rows for s in np.split(r.column(2 + LANES).flatten().to_numpy(), np.cumsum(pc.list_value_length(r.column(2 + LANES)).to_numpy())[:-1])]
        a, b = verified_links(ids, values, sets, radius)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last group of a batch may go on in the next."""
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True]).tolist()
            for at, to in zip(edge, edge[1:]):
                if held and key[at] != last:
                    yield linked(held)
                    held = []
                held.append(batch.slice(at, to - at))
                last = key[at]
        if held:
            yield linked(held)

    return run


def block_pairs(rows: DataFrame, parts: Column, dense: Column) -> DataFrame:
    """The rows (key, node, ...) under new keys; those of a dense key are dealt over ``parts`` blocks, and each two blocks make a key.

    Any two rows of a key share a new one, so that a key of any size is compared whole, by many tasks.
    """
    own = F.pmod(F.xxhash64("node", F.lit("block")), parts)
    other = F.explode(F.when(dense, F.sequence(F.lit(0).cast("long"), parts - 1)).otherwise(F.array(F.lit(-1).cast("long"))))
    dealt = rows.withColumn("own", F.when(dense, own).otherwise(F.lit(-1).cast("long"))).withColumn("other", other)
    return dealt.withColumn("key", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))).drop("own", "other")


def similar_links(docs: DataFrame, width: int = WIDE_WIDTH, radius: int = WIDE_RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between documents whose sets of shingles have a similarity of ``SIMILAR`` or more, each verified.

    Documents of equal sets link to the first of them, and only that goes on. Bands of MinHash values
    say which documents to compare at all, as no pigeonhole holds at such a radius (BANDS bands of
    BAND_ROWS values miss a pair of similarity 0.8 with a probability of 2e-4), and distances of
    256-bit fingerprints which of them are candidates (1e-4 are missed at 0.8). Every two documents of
    a key meet. What candidates connect is then compared by its sets of shingles, so that a set is
    shuffled once and not for each band.
    """
    rows = cut(sketches(docs, width).where("doc_id is not null"), "sketches")
    firsts = rows.groupBy("same").agg(F.min("doc_id").alias("node"))
    named = rows.join(firsts, "same")
    equal = named.where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    each = named.where("doc_id = node").select("node", *LANE_NAMES, F.explode(F.array_distinct("keys")).alias("key"))
    sizes = each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = block_pairs(each.join(sizes, "key"), F.ceil(2 * F.col("n") / block), F.col("n") > block).select("key", "node", *LANE_NAMES)
    candidates = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(compare_groups(radius), "a long, b long").distinct()
    clusters = components(candidates).select("node", F.col("component").alias("key"))
    sets = cut(shingle_sets(docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(clusters, "node"), width), "sets")
    sizes = sets.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("shingles")).alias("m"))
    parts = F.greatest(F.ceil(2 * F.col("n") / block), F.ceil(2 * F.col("m") / GROUP_SHINGLES))
    met = block_pairs(sets.join(sizes, "key"), parts, (F.col("n") > block) | (F.col("m") > GROUP_SHINGLES)).select("key", "node", *LANE_NAMES, "shingles")
    verified = met.repartition("key").sortWithinPartitions("key").mapInArrow(verify_groups(radius), "a long, b long")
    return equal.union(verified).distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those whose group has a smaller doc_id; null ids stay.

    A group is what the links of both kinds of fingerprints connect.
    """
    fps = cut(fingerprints(docs), "fingerprints")
    nodes, linked = fingerprint_links(fps, 2, BLOCK)
    members = fps.join(nodes, "fp").where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    groups = components(linked.union(members).union(similar_links(docs)))
    dropped = groups.where("component <> node").select(F.col("node").alias("doc_id"))
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
