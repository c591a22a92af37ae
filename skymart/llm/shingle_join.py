"""Near duplicates by n-gram Jaccard: a grouped prefix join.

A document's set holds its distinct shingles of five words. Two documents link when their sets
have a Jaccard similarity of at least 0.8; the result is the component of links of each document.

1. Sets that could link to nothing go first. A link needs at least 80 % of a set in common, so a
   set needs that part of its shingles to occur in another document. Documents are handled in
   chunks; a chunk sends each of its distinct shingles once to the shard of its hash (as packed
   arrays of 32 further bits), and each shard answers how many of every document's shingles occur
   elsewhere. Equal bits of different shingles only let a set stay that could have gone.
2. Of the rest, equal sets are one. Shingles are put in one global order, rarest first, and the
   prefix of a set is so long that linked sets share a prefix shingle.
3. Sets with identical prefix and size form one group. Only groups are indexed; a shingle with one
   group is dropped; the remaining groups are expanded into their members, and the members of a
   group are a list of their own. Of lists with the same members one stays.
4. A list isn't expanded into all pairs. In each round a few of its members meet all members of
   other components whose size, place in the list and bits allow a link, and are then done: first
   some of its largest component, then those of its smallest ones, more in each round. The bits of
   a set are the parities of its shingles by hash, which bound how many shingles differ; so sets
   that share shingles but don't link become few pairs. Members that share several lists meet in
   the first of those in which one of them meets all, not in each. Pairs are verified on whole sets,
   links merge components, and a list is finished when all its members are in one component. So
   every link between components is found, and a group of copies takes few pairs for each member.

Every step works on fixed-size chunks, shards of a bounded part of the hashes, or joins.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skymart.cluster import settle, ship
from skymart.llm import tokens
from skymart.llm.arrow import arrow_schema, doc_texts, fresh, map_rows, named
from skymart.llm.components import contracted, merged, settle_narrow
from skymart.operators.lookups import within

WORDS = 5
#: Least Jaccard similarity of a link, in percent.
PERCENT = 80
CHUNK_DOCS = 2000
CHUNK_SHINGLES = 1 << 20
#: Members of a list's largest component that meet the others, in the first rounds; then, in each
#: round, members of its smallest components: so many, and MORE_PIVOTS times the last ones.
LARGE_PIVOTS = (1, 6)
SMALL_PIVOTS = 64
MORE_PIVOTS = 8
#: Bits of a set, in numbers of 64.
BITS = 1024
#: Lists of a member, the first in order, by which it is told where a pair has met.
FIRST_LISTS = 32
#: Documents, and pairs to verify, are fetched by broadcasting ids up to this many.
BROADCAST_IDS = 1_000_000
_MANY = 65535


def shingle_sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every document of a batch."""
    for _, hashes, counts in tokens.hashed_texts(batch):
        grams = hashes
        for ahead in range(1, WORDS):
            grams = tokens.mix(grams[: max(0, len(hashes) - ahead)], hashes[ahead:])
        at = 0
        for count in counts.tolist():
            if count >= WORDS:
                own = np.sort(grams[at : at + count - WORDS + 1])
                first = np.empty(len(own), bool)
                first[0] = True
                np.not_equal(own[1:], own[:-1], out=first[1:])
                yield own[first]
            elif count:
                whole = hashes[at : at + 1]
                for k in range(1, count):
                    whole = tokens.mix(whole, hashes[at + k : at + k + 1])
                yield tokens.mix(whole, np.array([count], np.uint64))
            else:
                yield hashes[:0]
            at += count


def _signature(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _least(size: np.ndarray | int) -> np.ndarray | int:
    """Least overlap of a set of this size with any set that it links to."""
    return -(-PERCENT * size // 100)


def _bits(shingles: np.ndarray) -> list[int]:
    """Whether the set holds an odd number of shingles of each of BITS values of their hashes.

    A shingle that two sets do not share changes one of these bits.
    """
    odd = np.bincount((shingles & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


# --- 1. sets whose shingles occur elsewhere ---


def _chunks(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    ids: list[int | None] = []
    sets: list[np.ndarray] = []
    held = 0
    for batch in batches:
        for doc_id, own in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch), strict=True):
            ids.append(doc_id)
            sets.append(own)
            held += len(own)
            if len(ids) == most or held >= CHUNK_SHINGLES:
                yield ids, sets
                ids, sets, held = [], [], 0
    if ids:
        yield ids, sets


def _emit(shard_bits: int, chunk_docs: int):
    """Rows (kind, key, chunk, a, b): one of kind 0 a chunk, one of kind 1 a chunk and shard."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        first = TaskContext.get().partitionId() << 32
        for number, (ids, sets) in enumerate(_chunks(batches, chunk_docs)):
            chunk = first + number
            sizes = np.array([len(s) for s in sets], np.int64)
            every = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(every)
            every, owner = every[order], owner[order]
            begins = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])[: len(every)])
            times = np.diff(np.append(begins, len(every)))
            many = np.repeat(times > 1, times)
            shared = np.bincount(owner[many], minlength=len(sets))
            present = np.array([i is not None for i in ids])
            numbers = np.array([i or 0 for i in ids], np.int64)
            signatures = b"".join(map(_signature, sets))
            packed = b"".join(
                x.astype(t).tobytes()
                for x, t in ((numbers, "i8"), (present, "i8"), (sizes, "i8"), (shared, "i8"))
            )
            yield 0, chunk, chunk, packed, signatures
            distinct = every[begins]
            one = np.where(times > 1, _MANY, owner[begins]).astype(np.uint16)
            low = (distinct >> np.uint64(32 - shard_bits)).astype(np.uint32)
            shard = (distinct >> np.uint64(64 - shard_bits)).astype(np.int64)
            edges = np.flatnonzero(np.diff(shard)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(shard)], strict=True):
                if b > a:
                    yield 1, int(shard[a]), chunk, low[a:b].tobytes(), one[a:b].tobytes()

    return rows


def _answer(schema: pa.Schema):
    """From a shard's rows, how many of each document's shingles occur in another chunk."""

    def answer(group: pa.Table) -> pa.Table:
        if group.column("kind")[0].as_py() == 0:
            return group.select(["kind", "chunk", "a", "b"]).cast(schema)
        bits = [np.frombuffer(x, np.uint32) for x in group.column("a").to_pylist()]
        docs = [np.frombuffer(x, np.uint16) for x in group.column("b").to_pylist()]
        every = np.concatenate(bits)
        order = np.argsort(every)
        ordered = every[order]
        same = ordered[1:] == ordered[:-1]
        shared = np.zeros(len(every), bool)
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
        at, counts = 0, []
        for own in docs:
            chosen = own[shared[at : at + len(own)]]
            counts.append(np.bincount(chosen[chosen != _MANY]).astype(np.uint32).tobytes())
            at += len(own)
        columns = [group.column("kind"), group.column("chunk"), counts, [b""] * len(counts)]
        return pa.table(
            [pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(columns, schema, strict=True)],
            schema=schema,
        )

    return answer


def _decide(schema: pa.Schema):
    """From a chunk's rows, every document's set size and whether the set may link."""

    def decide(group: pa.Table) -> pa.Table:
        kinds = group.column("kind").to_pylist()
        packed = group.column("a").to_pylist()
        head = kinds.index(0)
        numbers, present, sizes, shared = np.frombuffer(packed[head], np.int64).reshape(4, -1)
        shared = shared.copy()
        for kind, blob in zip(kinds, packed, strict=True):
            if kind:
                counts = np.frombuffer(blob, np.uint32)
                shared[: len(counts)] += counts
        close = (sizes > 0) & (shared >= _least(sizes))
        marks = group.column("b")[head].as_py()
        return pa.table(
            [
                pa.array(numbers, mask=present == 0),
                pa.array([marks[i : i + 16] for i in range(0, len(marks), 16)], pa.binary()),
                pa.array(sizes),
                pa.array(close),
            ],
            schema=schema,
        )

    return decide


def _listed(docs: DataFrame, chunk_docs: int) -> DataFrame:
    """doc_id, signature, n_shingles and close of every document."""
    shard_bits = min(16, max(6, math.ceil(math.log2(docs.count() + 1)) - 11))
    emitted = map_rows(
        docs, _emit(shard_bits, chunk_docs), "kind int, key long, chunk long, a binary, b binary"
    )
    answers = "kind int, chunk long, a binary, b binary"
    results = "doc_id long, signature binary, n_shingles long, close boolean"
    answered = emitted.groupBy("kind", "key").applyInArrow(
        _answer(arrow_schema(docs, answers)), answers
    )
    return answered.groupBy("chunk").applyInArrow(_decide(arrow_schema(docs, results)), results)


# --- 2. distinct sets in a global order of shingles ---


def _sets(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """node, chunk, signature, size and shingles of every distinct set that may link."""
    first = listed.filter("close").groupBy("signature").agg(F.min("doc_id").alias("doc_id"))
    wanted = settle(first.select(F.col("doc_id").alias("wanted")).distinct())
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    chosen = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for own in shingle_sets(batch):
                if len(own):
                    yield _signature(own), len(own), own.tobytes(), _bits(own)

    sets = map_rows(chosen, rows, "signature binary, size long, shingles binary, bits array<long>")
    sets = sets.dropDuplicates(["signature"]).withColumn("node", F.monotonically_increasing_id())
    return settle(sets.withColumn("chunk", F.shiftright("node", 9)))


def _frequencies(schema: pa.Schema):
    def count(group: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, np.uint64) for x in group.column("hashes").to_pylist()]
        times = [np.frombuffer(x, np.uint32) for x in group.column("times").to_pylist()]
        distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(times)).astype(np.int64)[place]
        at, found = 0, []
        for own in hashes:
            sums = total[at : at + len(own)]
            found.append((own[sums > 1].tobytes(), sums[sums > 1].tobytes()))
            at += len(own)
        return pa.table(
            [group.column("chunk"), pa.array([x for x, _ in found], pa.binary()),
             pa.array([x for _, x in found], pa.binary())],
            schema=schema,
        )

    return count


def _shard_rows(shard_bits: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            chunks = np.array(batch.column("chunk").to_pylist())
            sets = [np.frombuffer(x, np.uint64) for x in batch.column("shingles").to_pylist()]
            for chunk in np.unique(chunks):
                own = [sets[i] for i in np.flatnonzero(chunks == chunk)]
                distinct, times = np.unique(np.concatenate(own), return_counts=True)
                shard = (distinct >> np.uint64(64 - shard_bits)).astype(np.int64)
                edges = np.flatnonzero(np.diff(shard)) + 1
                for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(shard)], strict=True):
                    yield (
                        int(shard[a]),
                        int(chunk),
                        distinct[a:b].tobytes(),
                        times[a:b].astype(np.uint32).tobytes(),
                    )

    return rows


def _prefixes(schema: pa.Schema):
    """Each set's prefix: the shingles of it that occur in other sets, and their places."""

    def prefix(sets: pa.Table, answers: pa.Table) -> pa.Table:
        hashes = np.concatenate(
            [np.zeros(0, np.uint64), *(np.frombuffer(x, np.uint64) for x in answers.column("hashes").to_pylist())]
        )
        times = np.concatenate(
            [np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in answers.column("times").to_pylist())]
        )
        order = np.argsort(hashes)
        hashes, times = hashes[order], times[order]
        rows = []
        for node, blob in zip(sets.column("node").to_pylist(), sets.column("shingles").to_pylist(), strict=True):
            own = np.frombuffer(blob, np.uint64)
            at = np.minimum(np.searchsorted(hashes, own), max(0, len(hashes) - 1))
            often = np.where(hashes[at] == own, times[at], 1) if len(hashes) else np.ones(len(own))
            size, need = len(own), _least(len(own))
            if (often > 1).sum() < need:
                continue
            first = np.lexsort((own, often))[: size - need + 1]
            places = np.flatnonzero(often[first] > 1)
            shared = own[first].astype(np.int64)
            mark = xxhash.xxh3_128_digest(shared.tobytes(), size & 0xFFFFFFFF)
            rows.append((node, size, mark, shared[places].tolist(), places.tolist()))
        columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return prefix


def _indexed(sets: DataFrame, shard_bits: int) -> DataFrame:
    """node, size, prefix mark, prefix shingles and places of the sets that still may link."""
    asked = map_rows(
        sets.select("chunk", "shingles"),
        _shard_rows(shard_bits),
        "shard long, chunk long, hashes binary, times binary",
    )
    answers = "chunk long, hashes binary, times binary"
    counted = asked.groupBy("shard").applyInArrow(_frequencies(arrow_schema(sets, answers)), answers)
    results = "node long, size long, mark binary, prefix array<long>, places array<int>"
    return (
        sets.select("chunk", "node", "shingles")
        .groupBy("chunk")
        .cogroup(counted.groupBy("chunk"))
        .applyInArrow(_prefixes(arrow_schema(sets, results)), results)
    )


# --- 3. lists of members that share a prefix shingle ---


def _lists(indexed: DataFrame) -> DataFrame:
    """list, node, size, place: every list has at least two members."""
    indexed = settle(indexed)
    groups = indexed.groupBy("mark", "size").agg(
        F.min("node").alias("leader"), F.count("*").alias("members")
    )
    of_group = settle(
        indexed.join(groups, ["mark", "size"]).select(
            "leader", "members", "node", "size", "prefix", "places"
        )
    )
    leaders = of_group.filter("leader = node").select(
        "leader", "size", F.explode(F.arrays_zip("prefix", "places")).alias("at")
    )
    leaders = leaders.select("leader", "size", F.col("at.prefix").alias("list"), "at.places")
    shared = leaders.groupBy("list").agg(F.count("*").alias("groups")).filter("groups > 1")
    met = leaders.join(shared.select("list"), "list")
    expanded = met.join(of_group.select("leader", "node"), "leader").select(
        "list", "node", "size", F.col("places").alias("place")
    )
    inside = of_group.filter("members > 1").select(
        F.xxhash64("leader", F.lit("group")).alias("list"), "node", "size", F.lit(0).alias("place")
    )
    return _one_of_equal(settle(expanded.union(inside)))


def _one_of_equal(lists: DataFrame) -> DataFrame:
    """lists without those that have the same members as another; of these the smallest stays.

    Its places bound the overlap of any two members as well as another's, as they share its shingle.
    """
    one, two = F.xxhash64("node"), F.xxhash64(F.lit(1), "node")
    members = lists.groupBy("list").agg(
        F.count("*").alias("members"), F.bit_xor(one).alias("one"), F.bit_xor(two).alias("two")
    )
    kept = members.groupBy("members", "one", "two").agg(F.min("list").alias("list"))
    return lists.join(kept.select("list"), "list", "left_semi")


# --- 4. links between components ---


def _may_link():
    """Whether sizes, places and bits leave room for a link of a member and a pivot (columns p_*)."""
    size, place = F.col("size"), F.col("place")
    p_size, p_place = F.col("p_size"), F.col("p_place")
    most = F.least(place, p_place) + 1 + F.least(size - place - 1, p_size - p_place - 1)
    sizes = 100 * F.least(size, p_size) >= PERCENT * F.greatest(size, p_size)
    places = (100 + PERCENT) * most >= PERCENT * (size + p_size)
    apart = [F.bit_count(F.col("bits")[k].bitwiseXOR(F.col("p_bits")[k])) for k in range(BITS // 64)]
    # Linked sets share all but 100 - PERCENT of a hundred shingles of their union.
    bits = (100 + PERCENT) * reduce(lambda a, b: a + b, apart) <= (100 - PERCENT) * (size + p_size)
    return sizes & places & bits


def _first_lists(rows: DataFrame, node: str, name: str) -> DataFrame:
    """The first lists of every node, in order."""
    lists = F.slice(F.sort_array(F.collect_list("list")), 1, FIRST_LISTS)
    return rows.groupBy(node).agg(lists.alias(name))


def _pairs(live: DataFrame, heads: DataFrame) -> DataFrame:
    """The pairs (a, b) of a list's member and pivot that may link, mostly once.

    A pair that meets in an earlier list, where it is let through if it may link, is no pair here.
    """
    live = live.join(_first_lists(live, "node", "own"), "node")
    heads = heads.join(_first_lists(heads, "p_node", "p_own"), "p_node")
    first = F.array_min(F.array_intersect("own", "p_own"))
    here = F.coalesce(first, F.col("list")) >= F.col("list")
    met = live.join(heads, "list").filter((F.col("label") != F.col("p_label")) & _may_link() & here)
    return met.select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b"))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    few = pairs.count() <= BROADCAST_IDS
    ends = pairs.select("b").distinct()
    shingles = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    others = sets.select(F.col("node").alias("b"), F.col("shingles").alias("other"))
    others = others.join(F.broadcast(ends) if few else ends, "b", "left_semi")
    both = shingles.join(F.broadcast(pairs) if few else pairs, "a").join(others, "b")

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for a, b, one, other in zip(
                *(batch.column(c).to_pylist() for c in ("a", "b", "one", "other")), strict=True
            ):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
                every = np.concatenate([x, y])
                every.sort()
                common = int((every[1:] == every[:-1]).sum())
                if 100 * common >= PERCENT * (len(x) + len(y) - common):
                    yield a, b

    return map_rows(both.select("a", "b", "one", "other"), rows, "a long, b long")


def _components(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """node and label: sets of one component have one label."""
    labels = settle_narrow(sets.select("node", F.col("node").alias("label")))
    bits = settle_narrow(sets.select("node", "bits"))
    lists, number, links = settle_narrow(lists), 0, None
    while True:
        large = number < len(LARGE_PIVOTS)
        pivots = LARGE_PIVOTS[number] if large else SMALL_PIVOTS * MORE_PIVOTS ** (number - len(LARGE_PIVOTS))
        sizes = labels.groupBy("label").agg(F.count("*").alias("weight"))
        live = settle_narrow(lists.join(labels.join(sizes, "label").join(bits, "node"), "node"))
        spans = live.groupBy("list").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        weight = F.desc("weight") if large else F.asc("weight")
        order = (weight, F.xxhash64("node", F.lit(number)), "node")
        rank = F.row_number().over(Window.partitionBy("list").orderBy(*order))
        heads = live.withColumn("rank", rank).filter(F.col("rank") <= pivots)
        heads = heads.join(spans.filter("low < high"), "list", "left_semi")
        heads = settle_narrow(
            heads.select("list", *[F.col(c).alias(f"p_{c}") for c in ("node", "size", "place", "label", "bits")])
        )
        if heads.isEmpty():
            return merged(labels, links) if links is not None else labels
        pairs = settle_narrow(_pairs(live, heads).distinct())
        labels, links = contracted(labels, _links(pairs, sets), links)
        open_lists = lists.join(heads.select("list").distinct(), "list", "left_semi")
        done = heads.select("list", F.col("p_node").alias("node"))
        lists = settle_narrow(open_lists.join(done, ["list", "node"], "left_anti"))
        number += 1


def _decided(docs: DataFrame, chunk_docs: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, signature and n_shingles of every document; and component of those with a word."""
    ship(docs.sparkSession)
    docs = doc_texts(docs)
    listed = settle(_listed(docs, chunk_docs))
    sets = _sets(docs, listed)
    shard_bits = min(16, max(4, math.ceil(math.log2(sets.count() + 1)) - 9))
    labels = _components(_lists(_indexed(sets, shard_bits)), sets)
    labelled = sets.select("node", "signature").join(labels, "node").select("signature", "label")
    known = listed.filter("n_shingles > 0").join(labelled, "signature", "left")
    # A set that is linked with none is a component by itself.
    alone = F.when(F.col("label").isNull(), F.col("signature")).alias("signature")
    component = F.struct("label", alone).alias("component")
    return listed, known.select("doc_id", "signature", "n_shingles", component)


def near_duplicates(docs: DataFrame, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    The component is named by its smallest doc_id. A document with fewer than five words has its
    whole sequence as one shingle; null, empty and blank texts have no shingle, link with nothing
    and name themselves. Equal texts (repeated rows, too) are in one component; a null doc_id is
    never the smallest unless all are null. No rows give none; other columns are not read.
    """
    listed, known = _decided(docs, chunk_docs)
    smallest = known.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    alone = listed.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return known.join(smallest, "component").select("doc_id", "n_shingles", "component_id").union(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs, with all their columns, without all but one row of each component.

    The row with the smallest doc_id stays; null is the largest. Of several rows of that doc_id the
    one with the smallest digests of its shingles and of its text stays, of equal ones any. Rows without a
    word all stay. Rows are told apart by doc_id alone where it occurs once, and by their texts
    where it occurs again, so that no text goes for another one of the same doc_id.
    """
    listed, known = _decided(docs, CHUNK_DOCS)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "signature")
    first = known.groupBy("component").agg(F.min(order).alias("first"))
    known = settle(known.join(first, "component").select("doc_id", "signature", "first"))
    gone = known.filter(~order.eqNullSafe(F.col("first"))).select("doc_id", "signature").distinct()
    again = listed.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1")
    gone, again = settle(gone), settle(again.select("doc_id"))

    id_, body, of, own, place = fresh("id", "body", "of", "own", "place")
    given = docs.withColumn(id_, named("doc_id").cast("long"))
    some = again.select(F.col("doc_id").alias(of))
    some = F.broadcast(some) if within(some, BROADCAST_IDS) else some
    repeated = F.col(id_).eqNullSafe(F.col(of))
    lost = gone.select(F.col("doc_id").alias(own)).distinct()
    lost = F.broadcast(lost) if within(lost, BROADCAST_IDS) else lost
    once = given.join(some, repeated, "left_anti").join(lost, F.col(id_).eqNullSafe(F.col(own)), "left_anti")
    if again.isEmpty():
        return once.drop(id_)

    # Repeated doc_ids: each text's shingles decide, and of a component's rows one stays.
    digest = F.md5(F.coalesce(named("text").cast("string"), F.lit("")))
    several = given.join(some, repeated, "left_semi").withColumn(body, digest)
    texts = several.select(F.col(id_).alias("doc_id"), F.col(body).alias("body"), named("text").cast("string").alias("text"))

    def signed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("body").to_pylist(), shingle_sets(batch), strict=True)
            for doc_id, digest, shingles in rows:
                if len(shingles):
                    yield doc_id, digest, _signature(shingles)

    pairs = settle(map_rows(texts, signed, "doc_id long, body string, signature binary").distinct())
    kept = known.filter(order.eqNullSafe(F.col("first"))).select("doc_id", "signature").distinct()
    same = pairs["doc_id"].eqNullSafe(kept["doc_id"]) & (pairs["signature"] == kept["signature"])
    best = pairs.join(kept, same, "left_semi").groupBy("doc_id", "signature").agg(F.min("body").alias("body"))
    best = best.select(F.col("doc_id").alias(of), F.col("body").alias(own))
    chosen = F.col(id_).eqNullSafe(F.col(of)) & (F.col(body) == F.col(own))
    stays = several.join(best, chosen, "left_semi")
    one = Window.partitionBy(id_, body).orderBy(id_)
    stays = stays.withColumn(place, F.row_number().over(one)).filter(F.col(place) == 1).drop(place)
    worded = pairs.select(F.col("doc_id").alias(of), F.col("body").alias(own))
    blank = several.join(worded, chosen, "left_anti")
    return once.drop(id_).union(stays.union(blank).drop(id_, body))
