"""Near-duplicate groups by one-permutation MinHash with optimal densification, banded buckets and star edges.

1. Each text becomes a set of hashed word shingles and a one-permutation sketch:
   one hash orders all shingles, its top bits are the bin, the least value of a bin
   is the sketch entry.  An empty bin takes the entry of the bin that is first in its
   own fixed random order of bins (optimal densification), so two sketches agree in
   a bin with a probability equal to the Jaccard similarity.
2. Rows of equal shingle sets collapse to the smallest id; only these representatives go on.
3. Each band of ROWS bins is a bucket key.  Texts whose similarity is at the threshold
   share a bucket but for a probability of (1 - 0.8**ROWS)**BANDS, 3e-6 here.
4. Candidate edges are stars: in a bucket, every member is paired with its hub only, the
   member with most bucket mates.  Pairs that can't be similar enough go by two exact tests, of
   the sets' sizes and of parity bits: each shingle flips one of PARITIES bits, so that two
   bit vectors differ in no more places than the sets have members that differ.  The
   others are confirmed on the full shingle sets, and components are formed.
5. What a star can miss is a link between members of different components, neither being the
   hub.  A bucket whose other members are in one component is done.  One of at most SMALL others
   has its pairs of different components tested as in 4.  In a larger one each member is known by
   its difference to the hub, the shingles that just one of the two has.  Two members of which
   one at least is not linked to the hub can only be linked if their differences share so
   many shingles that the first few of each, in one order, have one in common (the prefix
   filter); what all members share, a passage or a template, is in no difference.  The bounds:
   with c = (1 - t) / (1 + t), a and b are linked if |a ^ b| <= c * (|a| + |b|), and
   |a ^ b| = |Da| + |Db| - 2 * |Da & Db|.  These first shingles are the keys of smaller buckets, which lack the
   hub; the larger ones of them get stars and keys again.  What is large after DIVISIONS of these has its pairs tested
   as small buckets have: only pairs that pass the two tests of 4 leave that join.  No bucket is capped.

Only bounded rows move: sketches as 8-byte band keys and parity bits, edges, and the shingle
sets of documents that share a bucket, recomputed from the text.  Hot keys are
pre-aggregated (minimum, count) before a shuffle; joins on them can be split by AQE.
"""

from __future__ import annotations

import math
from functools import reduce
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajectra.llm import textscan as ts
from trajectra.llm.shared import cut

BINS, ROWS, BANDS = 256, 6, 42
#: Bits of a set's parity vector, and the size up to which a bucket's pairs are tested one by one.
PARITIES, SMALL = 512, 64
#: How often large buckets are divided by differences, those of over SMALL members at first, then of over 4 times as many each time;
#: what is large even then has its pairs tested in the join.  (A division makes a row of each key: in small buckets, pairs are fewer.)
DIVISIONS = 3
#: Edges (half a MB) of which the driver finds the components by itself, where rounds of exchanges would cost more than the work; larger graphs go by rounds.
FEW_EDGES = 1 << 15
_U = np.uint64
#: ORDER[j] are all bins in the order in which the empty bin j asks them; RANK is its inverse.
_rng = np.random.default_rng(7)
ORDER = np.argsort(_rng.random((BINS, BINS)), axis=1)
RANK = np.argsort(ORDER, axis=1)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted hashes of each text's distinct word shingles; A-Z are lower-cased.

    A text of fewer words is one shingle of all its words; without words the set is empty.
    """
    for g in ts.groups(texts):
        w = ts.words(g, ts.NOT_SPACE, ts.LOWER[g.data])
        at, h = ts.windows(w, words)
        h = ts.mix(h ^ _U(words))
        first = np.searchsorted(w.doc[at], np.arange(g.n + 1))
        for k in range(g.n):
            if first[k + 1] > first[k]:
                yield np.unique(h[first[k] : first[k + 1]])
            elif (few := w.hash[w.first[k] : w.first[k + 1]]).size:
                whole = np.zeros(1, np.uint64)
                for x in few:
                    whole = whole * _U(0x9E3779B97F4A7C15) + x
                yield ts.mix(whole ^ _U(1000 + len(few)))
            else:
                yield np.zeros(0, np.uint64)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The densified sketch of a sorted, non-empty set."""
    bins = (hashes >> _U(64 - BINS.bit_length() + 1)).astype(np.int64)
    filled, first = np.unique(bins, return_index=True)
    out = np.zeros(BINS, np.uint64)
    out[filled] = hashes[first]
    if len(filled) < BINS:
        empty = np.ones(BINS, bool)
        empty[filled] = False
        at = np.flatnonzero(empty)
        out[at] = out[filled[np.argmin(RANK[np.ix_(at, filled)], axis=1)]]
    return out


_BAND_SALT = ts.mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key for each band, different for different bands."""
    rows = values[: BANDS * ROWS].reshape(BANDS, ROWS)
    key = _BAND_SALT.copy()
    for k in range(ROWS):
        key = ts.mix(key * _U(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


def parity_bits(hashes: np.ndarray) -> np.ndarray:
    """For each of PARITIES classes of hashes whether the set has an odd number of it, packed."""
    # the low bits: sketches use the top ones
    counts = np.bincount((hashes & _U(PARITIES - 1)).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(bool)).view(np.int64)


_SIGNATURE = "struct<n_shingles:bigint,set_a:bigint,set_b:bigint,bands:array<bigint>,bits:array<bigint>>"


def _signatures(words: int):
    @F.arrow_udf(_SIGNATURE)
    def signatures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            n, a, b, keys, bits = [], [], [], [], []
            for s in shingle_sets(texts, words):
                n.append(len(s))
                # two sums over the set, each of differently mixed members: its 128-bit name
                a.append(int(np.sum(ts.mix(s ^ _U(0xA5A5A5A5)), dtype=np.uint64).view(np.int64)))
                b.append(int(np.sum(ts.mix(s ^ _U(0x5C5C5C5C5C)), dtype=np.uint64).view(np.int64)))
                if len(s):
                    keys.append(band_keys(sketch(s)))
                    bits.append(parity_bits(s))
            has = np.array(n, np.int64) > 0
            lists = []
            for parts, width in ((keys, BANDS), (bits, PARITIES // 64)):
                ends = np.append(0, np.cumsum(has * width)).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))))
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), *lists], ["n_shingles", "set_a", "set_b", "bands", "bits"])

    return signatures


def may_be_linked(percent: int) -> Column:
    """Whether (n, bits) and (hub_n, hub_bits) can be of sets of this similarity; never false for those that are."""
    differing = sum(F.bit_count(F.get("bits", F.lit(k)).bitwiseXOR(F.get("hub_bits", F.lit(k)))) for k in range(PARITIES // 64))
    return (100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")) & ((100 + percent) * differing <= (100 - percent) * (F.col("n") + F.col("hub_n")))


def _sets(words: int):
    @F.arrow_udf("binary")
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([s.tobytes() for s in shingle_sets(texts, words)], pa.binary())

    return sets


def _linked(percent: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return linked


def difference_keys(hub: np.ndarray, own: np.ndarray, near: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys from the first shingles of own's difference to the hub, and which of them are probes.

    Let own and another set be linked, and one of them not linked to the hub nor ``near``; then they have one of
    these keys in common, of which one at least is no probe.  ``near`` sets may or may not be linked to the hub.

    A set is indexed by so many shingles as sets of larger or equal differences call for, and probes with more of them for
    smaller differences; a prefix is the shorter, the better the other's size is known.
    """
    # what own has besides the hub comes first in the order, as the hub's shingles are missing in more sets
    ordered = np.concatenate([np.setdiff1d(own, hub, assume_unique=True), np.setdiff1d(hub, own, assume_unique=True)])
    n, x, h = len(ordered), len(own), len(hub)
    apart, widest = (100 - percent) / (100 + percent), x * 100 / percent  # a linked set has at most so many members
    limit = apart * (x + widest)
    indexed = math.ceil((n + n - limit) / 2 - 1e-9)
    limit = apart * (x + min(widest, h + n))
    probing = math.ceil((n + max(0, math.ceil(n - limit - 1e-9)) - limit) / 2 - 1e-9)
    if near:  # the other's difference is of more than apart * (its size + h)
        common = ((100 + percent) * n + (100 - percent) * (h - x)) // (2 * (100 + percent)) + 1
        indexed, probing = max(indexed, common), max(probing, common)
        if n <= apart * (x * percent / 100 + h) - 1e-9:  # so none is smaller
            probing = indexed
    first = ordered[: max(0, n - max(1, min(indexed, probing)) + 1)]
    return ts.mix(first ^ ts.mix(np.bitwise_xor.reduce(ts.mix(hub)) + np.arange(1, dtype=np.uint64))), np.arange(len(first)) > n - max(1, indexed)


_KEYED = "key bigint, doc bigint, probe boolean"


def _keys(percent: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, probes = [np.zeros(0, np.int64)], [np.zeros(0, bool)]
            for group, near, left, right in zip(batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_pylist(), batch.column(3), batch.column(4)):
                key, probe = difference_keys(np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64), near, percent)
                found.append(ts.mix(key + group).view(np.int64))
                probes.append(probe)
            docs = np.repeat(batch.column(0).to_numpy(), [len(k) for k in found[1:]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(docs, pa.int64()), pa.array(np.concatenate(probes))], ["key", "doc", "probe"])

    return keys


def least_reachable(edges: pa.Table) -> dict[int, int]:
    """For each node of the edges (u, v) the smallest node reachable, unless that is itself."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while top in above:
            top = above[top]
        while x != top:
            above[x], x = top, above[x]
        return top

    for u, v in zip(edges["u"].to_pylist(), edges["v"].to_pylist()):
        a, b = root(u), root(v)
        if a != b:
            above[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(above)}


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for each node of edges (u, v) that isn't its own root, by large-star and small-star rounds."""
    e = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if e.count() <= FEW_EDGES:
        found = least_reachable(e.toArrow())
        return e.sparkSession.createDataFrame(pa.table({"node": pa.array(found, pa.int64()), "root": pa.array(found.values(), pa.int64())}))
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(down.select("u", F.col("m").alias("v"))).distinct()
        e = cut(small)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(now)


def split_by(rows: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``column`` may be in ids (one column), and the others, which surely aren't; null isn't.

    What is broadcast is a bit map of at most 2**28 bits, in at most 2**22 rows of 16 bytes, whatever the
    number of ids.  It saves the others a shuffle of their wide columns.
    """
    (key,) = ids.columns
    words = 1 << max(10, min(22, (16 * ids.count()).bit_length() - 6))
    place = lambda c: (F.pmod(F.xxhash64(c), F.lit(words)), F.shiftrightunsigned(F.xxhash64(c), 40).bitwiseAND(F.lit(63)).cast("int"))
    at, bit = place(F.col(key))
    bits = ids.select(at.alias("__at"), F.expr("1L").alias("one"), bit.alias("bit")).groupBy("__at").agg(F.bit_or(F.call_function("shiftleft", "one", "bit")).alias("__bits"))
    at, bit = place(F.col(column))
    tested = rows.withColumns({"__at": at, "__bit": bit}).join(F.broadcast(bits), "__at", "left").withColumn("__hit", F.coalesce(F.expr(f"shiftright(__bits, __bit) & 1 = 1 AND {column} IS NOT NULL"), F.lit(False)))
    return tuple(tested.filter(f"{'' if hit else 'NOT '}__hit").select(*rows.columns) for hit in (True, False))


def among(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``column`` is in ids (one column, distinct)."""
    return split_by(rows, column, ids)[0].join(ids.withColumnRenamed(ids.columns[0], column), column, "left_semi")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Rows are linked where 100 * |intersection| >= percent * |union| of their shingle
    sets; component_id is the smallest doc_id reachable and kept is whether it is the row's
    own.  Rows without words (null or empty texts too) have no links.  Rows of one
    doc_id are one node, with the links of all their texts, and all returned.  A null doc_id can't be named: it
    has a null component and is kept.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed = cut(rows.select("doc_id", _signatures(words)(F.col("text")).alias("s")).select("doc_id", "s.*"))
    live = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    name = ["n_shingles", "set_a", "set_b"]
    reps = live.groupBy(*name).agg(F.min(F.struct("doc_id", "bands", "bits")).alias("r")).select(*name, F.col("r.doc_id").alias("rep"), "r.bands", "r.bits")
    keyed = reps.select(F.explode("bands").alias("key"), F.col("rep").alias("doc"))
    shared = keyed.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high").select("key")
    buckets = cut(keyed.join(shared, "key").distinct())
    roots = cut(buckets.select(F.col("doc").alias("node"), F.col("doc").alias("root")).distinct())
    ids = roots.select(F.col("node").alias("doc"))
    facts = cut(reps.select(F.col("rep").alias("doc"), F.col("n_shingles").alias("n"), "bits").join(ids, "doc", "left_semi"))
    sets = among(rows, "doc_id", ids).select(F.col("doc_id").alias("doc"), _sets(words)(F.col("text")).alias("set")).withColumn("name", F.xxhash64("set"))
    sets = cut(sets.dropDuplicates(["doc", "name"]).select("doc", "set"))
    as_hub = lambda df: df.select(F.col("doc").alias("hub"), *(F.col(c).alias(f"hub_{c}") for c in df.columns if c != "doc"))
    root_of = lambda column: roots.select(F.col("node").alias(column), F.col("root").alias(f"{column}_root"))

    def with_sets(pairs: DataFrame, first: bool = False) -> DataFrame:
        # in later turns few sets are needed, and only these are shuffled
        needed = sets if first else split_by(sets, "doc", pairs.select("hub").union(pairs.select("doc")).distinct())[0]
        return pairs.join(as_hub(needed), "hub").join(needed, "doc")

    def confirmed(likely: DataFrame, first: bool = False) -> DataFrame:
        """The pairs (hub, doc) that are linked; likely is cut."""
        if likely.isEmpty():
            return likely
        whole = with_sets(likely, first).select("hub", "doc", "hub_set", "set")
        return cut(whole.mapInArrow(_linked(percent), "hub bigint, doc bigint").distinct())

    def starred(groups: DataFrame) -> DataFrame:
        """key, doc, hub for each member but its group's hub, the member with most mates."""
        sizes = groups.groupBy("key").agg(F.count("*").alias("size"))
        weight = groups.join(sizes, "key").groupBy("doc").agg(F.sum("size").alias("weight"))
        hubs = groups.join(weight, "doc").groupBy("key").agg(F.max(F.struct("weight", -F.col("doc"), "doc"))["doc"].alias("hub"))
        return cut(groups.join(hubs, "key").filter("doc <> hub").select("key", "doc", "hub"))

    def likely_stars(stars: DataFrame) -> DataFrame:
        pairs = stars.select("hub", "doc").distinct().join(as_hub(facts), "hub").join(facts, "doc")
        return cut(pairs.filter(may_be_linked(percent)).select("hub", "doc").distinct())

    def mixed(groups: DataFrame, bound: int) -> tuple[DataFrame, DataFrame]:
        """Members of groups that hold a pair of different components, not both probes: in small groups, and in the others."""
        placed = groups.join(root_of("doc"), "doc")
        some = placed.groupBy("key").agg(F.count("*").alias("size"), F.min("doc_root").alias("a"), F.max("doc_root").alias("b"), F.min("probe").alias("probes")).filter("a < b AND NOT probes").select("key", "size")
        found = cut(placed.join(some, "key"))
        return found.filter(F.col("size") <= bound), found.filter(F.col("size") > bound)

    def pairs_of(groups: DataFrame) -> DataFrame:
        """The pairs of different components in each group that may be linked."""
        known = groups.select("key", "doc", F.col("doc_root").alias("root"), "probe").join(facts, "doc")
        left = known.select("key", *(F.col(c).alias(f"hub_{c}") for c in ("root", "probe", "n", "bits")), F.col("doc").alias("hub"))
        return left.join(known, "key").filter("hub < doc AND root <> hub_root AND NOT (probe AND hub_probe)").filter(may_be_linked(percent)).select("hub", "doc").distinct()

    def narrowed(large: DataFrame, linked: DataFrame | None) -> DataFrame:
        """key, doc of the groups that the differences to the hubs make of large groups; near: one component, or linked.

        At first the groups of one hub are taken together.  Later each is divided by itself: so it only gets smaller, as it loses its hub.
        """
        within = F.lit(0).cast("bigint") if linked is None else F.col("key")
        pairs = large.select(within.alias("within"), "hub", "doc", "doc_root").distinct().join(root_of("hub"), "hub").withColumn("near", F.col("doc_root") == F.col("hub_root"))
        if linked is not None:
            pairs = pairs.join(linked.withColumn("link", F.lit(True)), ["hub", "doc"], "left").withColumn("near", F.col("near") | F.col("link").isNotNull())
        pairs = cut(pairs.select("within", "hub", "doc", "near"))
        return cut(with_sets(pairs).select("doc", "within", "near", "hub_set", "set").mapInArrow(_keys(percent), _KEYED).groupBy("key", "doc").agg(F.min("probe").alias("probe")))

    late, waiting = [], []
    stars = starred(buckets)
    linked = confirmed(likely_stars(stars), True)
    if not linked.isEmpty():  # nearly all links are found here; the roots only spare comparisons, so later links join these components at the end
        found = components(linked.select(F.col("hub").alias("u"), F.col("doc").alias("v")))
        roots = cut(roots.select("node").join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root")))
    as_members = lambda stars: stars.select("key", "doc", F.lit(False).alias("probe"))
    small, large = mixed(as_members(stars), SMALL)
    linked = None
    for division in range(DIVISIONS):
        waiting.append(pairs_of(small))
        if large.isEmpty():
            break
        if division:
            stars = starred(large.select("key", "doc"))
            linked = confirmed(likely_stars(stars))
            late.append(linked)
            large = mixed(as_members(stars), 0)[1]
        small, large = mixed(narrowed(large.join(stars, ["key", "doc"]), linked), SMALL << 2 * (division + 1))
    else:
        waiting += [pairs_of(small), pairs_of(large)]
    late.append(confirmed(cut(reduce(DataFrame.unionByName, waiting).distinct())))
    late = [found for found in late if not found.isEmpty()]
    if late:
        ends = reduce(DataFrame.unionByName, late).select("hub", "doc").join(root_of("hub"), "hub").join(root_of("doc"), "doc")
        found = components(ends.select(F.col("hub_root").alias("u"), F.col("doc_root").alias("v"))).select(F.col("node").alias("root"), F.col("root").alias("least"))
        roots = roots.join(found, "root", "left").select("node", F.coalesce("least", "root").alias("root"))
    named = reps.select(*name, "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(*name, F.coalesce("root", "rep").alias("component"))
    joined = signed.select("doc_id", *name).join(named, name, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
