"""Exact Jaccard join of word n-gram sets by rare-first prefix filtering; documents to classes of links.

The work goes in passes over narrow rows; texts are never shuffled:

1. Documents with one and the same set are one representative from here on.
2. A table of bounded size counts documents per hash slot of their n-grams. Ordering n-grams by
   (count of the slot, hash) puts rare ones first and is the same order for every document, which is
   all that prefix filtering needs. A set of size x that overlaps another one enough shares one of
   its first x - ceil(t x) + 1 n-grams with the first ones of the other.
3. Members of a prefix n-gram that few documents share are paired with each other, filtered by
   length, position and suffix, and verified once per pair.
4. Of a prefix n-gram that many share, every member is paired with one leader only, filtered and
   verified likewise. Members far from their leader go on to another one, a few times.
5. Members near one leader that are still in different classes meet by the n-grams in which they
   differ from it, again rare first; what no leader was near to meets by its prefix n-grams in full.

A group of thousands of near copies costs one pair a member in step 4, and in step 5 only pairs that
share an edit.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunewright.llm.common import prepare, release, serve, staged
from tunewright.llm.components import components

#: Pairs of one leader that are verified together.
LOT = 256
#: A table of more (leader, document) rows than that is not broadcast; a row is 24 bytes.
BROADCAST_ROWS = 1_000_000
#: Rounds of leaders.
ROUNDS = 2
#: Documents of an n-gram that are paired with each other; of more, each is paired with a leader.
FEW = 6
#: A member is near its leader up to so many percent of similarity below the threshold, and the
#: distances of two that link differ by one minus the threshold at most.
NEAR = 8
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS


#: Bytes hashed at once.
SEGMENT = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(3).integers(0, 1 << 64, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z


@lru_cache(1)
def _places() -> np.ndarray:
    """A random odd number for every place in a word."""
    return np.random.default_rng(4).integers(0, 1 << 64, SEGMENT + 1, np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _segment_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[0::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    if len(starts):
        # places count from the start of each word; those of the white space after it do not matter
        first = int(starts[0])
        place = np.arange(first, len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
        np.cumsum(_BYTE[data[first:]] * _places()[place], out=sums[first + 1 :])
    return starts, _mix(sums[ends] - sums[starts])


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word: a sum over its bytes of random numbers of byte and place.

    A word is what no white space cuts; two words of one hash would need an unlucky draw of those numbers.

    Long data go by segments cut at white space; a word longer than a segment is hashed by its own.
    """
    whole = np.frombuffer(data, np.uint8)
    at, starts, hashes = 0, [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    while at < len(whole):
        end = min(len(whole), at + SEGMENT)
        if end < len(whole):
            cut = np.flatnonzero(_SPACE[whole[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:  # one word of more than a segment
                rest = np.flatnonzero(_SPACE[whole[end:]])
                end = end + int(rest[0]) if len(rest) else len(whole)
                word = data[at:end].lower()
                starts.append(np.array([at]))
                hashes.append(np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64))
                at = end
                continue
        found, value = _segment_words(whole[at:end])
        starts.append(found + at)
        hashes.append(value)
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


def _grams(words: np.ndarray, width: int) -> np.ndarray:
    size = max(0, len(words) - width + 1)
    key = np.full(size, width, np.uint64)
    for i in range(width):
        key = _mix(key * _BASE + words[i : i + size])
    return key


def shingles(texts: list[bytes | None], n: int = 3):
    """Per text, the sorted distinct 64-bit hashes of its word n-grams.

    A-Z are lower-cased, words are separated by space and \\x09-\\x0D. Fewer than n words are one
    n-gram; a null text or one without words has none. Some texts are hashed together.
    """
    at = 0
    while at < len(texts):
        some, size = [], 0
        while at < len(texts) and (not some or size < SEGMENT // 2):
            some.append(texts[at] or b"")
            size += len(some[-1]) + 1
            at += 1
        starts, words = word_hashes(b" ".join(some))
        ends = np.cumsum([len(t) + 1 for t in some])
        cuts = np.searchsorted(starts, ends)
        keys = _grams(words, n)
        first = 0
        for last in cuts.tolist():
            if last - first >= n:
                yield np.unique(keys[first : last - n + 1])
            else:
                yield _grams(words[first:last], last - first) if last > first else np.zeros(0, np.uint64)
            first = last


def _bytes(column) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _required(size: np.ndarray | int, percent: int):
    """Least intersection with any partner: ceil(t * size)."""
    return -(-percent * size // 100)


def slot_counts(documents: DataFrame, text: str, n: int) -> np.ndarray:
    """Documents per hash slot of their n-grams, over all documents; 2^18 numbers whatever the input."""

    def count(batches):
        serve("jaccard")
        sums = np.zeros(SLOTS, np.int64)
        for batch in batches:
            found = [grams >> np.uint64(64 - SLOT_BITS) for grams in shingles(_bytes(batch.column(0)), n)]
            if found:
                sums += np.bincount(np.concatenate(found).astype(np.int64), minlength=SLOTS)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], ["slot", "n"])

    found = (
        documents.select(text).mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    )
    counts = np.zeros(SLOTS, np.int64)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    return counts


def _signatures(counts: np.ndarray, n: int, percent: int):
    """Batches of (key, text) to (key, size, digest, prefix n-grams in rare-first order, bins)."""

    def run(batches):
        serve("jaccard")
        for batch in batches:
            sizes, digests, prefixes, bins = [], [], [], []
            for found in shingles(_bytes(batch.column(1)), n):
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                rare = found[np.argsort(counts[(found >> np.uint64(64 - SLOT_BITS)).astype(np.int64)], kind="stable")]
                prefixes.append(rare[: len(found) - _required(len(found), percent) + 1 if len(found) else 0].view(np.int64))
                bins.append(_sketch(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array(bins, pa.binary()),
                ],
                ["id", "size", "digest", "prefix", "bins"],
            )

    return run


def _may_link(percent: int) -> str:
    """Length and position filter of postings x and y that share an n-gram, as SQL.

    The pair needs o >= t / (1 + t) * (|x| + |y|) common n-grams; the shared one and what follows
    both positions bounds them from above.
    """
    return f"""
        100 * least(x.size, y.size) >= {percent} * greatest(x.size, y.size)
        AND {100 + percent} * (1 + least(x.size - x.pos - 1, y.size - y.pos - 1) + least(x.pos, y.pos))
            >= {percent} * (x.size + y.size)"""


def _sketch(found: np.ndarray) -> bytes:
    """Counts of the n-grams by the first bits of their hash: about one byte for four n-grams."""
    bits = max(6, (len(found) // 4).bit_length())
    return np.minimum(np.bincount((found >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _sketch_fits(percent: int):
    """Suffix filter of pairs (a, b, size_a, size_b, sketches): sets differ at least by what their counts differ."""

    def run(batches):
        serve("jaccard")
        for batch in batches:
            size_a, size_b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            apart = np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column(4), batch.column(5))):
                p, q = (np.frombuffer(v.as_py(), np.uint8).astype(np.int64) for v in (x, y))
                bins = min(len(p), len(q))
                apart[i] = np.abs(p.reshape(bins, -1).sum(axis=1) - q.reshape(bins, -1).sum(axis=1)).sum()
            both = size_a + size_b
            fits = (100 + percent) * (both - apart) >= 2 * percent * both
            kept = batch.filter(pa.array(fits))
            yield pa.RecordBatch.from_arrays(kept.columns[:4], ["a", "b", "size_a", "size_b"])

    return run


def few(ids: DataFrame) -> DataFrame:
    """A narrow table, to be broadcast where it is small enough; its rows are counted."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def _similar(percent: int) -> str:
    return f"100 * both >= {percent} * (size_a + size_b - both)"


def _set_rows(n: int):
    """Batches of (lead, salt, id, text) with the n-gram set of the text, as bytes of sorted 64-bit hashes."""

    def run(batches):
        serve("jaccard")
        for batch in batches:
            sets = [found.tobytes() for found in shingles(_bytes(batch.column(3)), n)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sets, pa.binary())], ["lead", "salt", "id", "grams"])

    return run


def _compared(batches):
    """Rows sorted by (lead, salt), the lead's own set first, to (lead, id, set of the lead, set of the id)."""
    serve("jaccard")
    group, lead_set, last = None, None, None
    for batch in batches:
        out = []
        for lead, salt, doc, grams in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
            if (lead, salt) != group:
                group, lead_set, last = (lead, salt), None, None
            if doc == last:
                continue  # a repeated row
            last = doc
            found = np.frombuffer(grams.as_py(), np.uint64)
            if doc == lead:
                lead_set = found
            elif lead_set is not None:
                out.append((lead, doc, lead_set, found))
        yield out


def _overlaps(batches):
    """(a, b, both) of each lead and other id."""
    for rows in _compared(batches):
        out = [(a, b, len(np.intersect1d(x, y, assume_unique=True))) for a, b, x, y in rows]
        columns = list(zip(*out)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "both"])


def _differences(batches):
    """(lead, id, grams): the n-grams that only one of the two has."""
    for rows in _compared(batches):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([a for a, _, _, _ in rows], pa.int64()),
                pa.array([b for _, b, _, _ in rows], pa.int64()),
                pa.array([np.setxor1d(x, y, assume_unique=True).view(np.int64) for _, _, x, y in rows], pa.list_(pa.int64())),
            ],
            ["lead", "id", "grams"],
        )


class Join:
    """One run over documents (id, text); `links` are the verified pairs of representatives."""

    def __init__(self, documents: DataFrame, n: int, percent: int):
        self.documents, self.n, self.percent = documents, n, percent
        counts = slot_counts(documents, "text", n)
        self.signed = staged(
            documents.select("id", "text").mapInArrow(
                _signatures(counts, n, percent), "id long, size long, digest binary, prefix array<long>, bins binary"
            ).withColumn("row", F.monotonically_increasing_id()),
            "signatures",
        )
        #: every set with the id that stands for it
        named = F.when(F.col("id").isNotNull(), F.struct("id", "row"))
        first = self.signed.groupBy("digest").agg(F.min(named).alias("first"))
        self.classes = staged(first.select("digest", F.col("first.id").alias("rep"), F.col("first.row").alias("row")), "classes")
        # what stands for no set: found over narrow rows, and few beside all rows
        others = staged(self.signed.select("row").join(self.classes.select("row"), "row", "left_anti"), "others")
        self.reps = staged(self.signed.where("size > 0 AND id IS NOT NULL").join(few(others), "row", "left_anti").drop("digest", "row"), "reps")
        release(others)
        self.sketches = self.reps.select("id", "size", "bins")
        self.postings = self.reps.select("id", "size", F.posexplode("prefix").alias("pos", "gram"))

    def _shared(self, postings: DataFrame) -> DataFrame:
        """Members of the n-grams that several prefixes share, with the n-gram's number of members and leader."""
        several = postings.groupBy("gram").agg(F.count("*").alias("n"), F.min("id").alias("lead")).where("n > 1")
        return staged(postings.join(several, "gram"), "postings")

    def _likely(self, pairs: DataFrame, percent: int) -> DataFrame:
        """Pairs (a, b) once each, with sizes, that the suffix filter lets through."""
        left = self.sketches.select(F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("bins").alias("bins_a"))
        right = self.sketches.select(F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("bins").alias("bins_b"))
        both = pairs.distinct().join(left, "a").join(right, "b").select("a", "b", "size_a", "size_b", "bins_a", "bins_b")
        return staged(both.mapInArrow(_sketch_fits(percent), "a long, b long, size_a long, size_b long"), "pairs")

    def _dealt(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) dealt by a, a lot of them together, so that the set of a is shipped once a lot: (lead, id, salt)."""
        lots = pairs.groupBy("a").agg(F.ceil(F.count("*") / LOT).alias("lots"))
        dealt = pairs.join(lots, "a").select(F.col("a").alias("lead"), F.col("b").alias("id"), F.pmod(F.xxhash64("b"), F.col("lots")).alias("salt"))
        return staged(dealt.unionByName(dealt.select("lead", F.col("lead").alias("id"), "salt").distinct()), "dealt")

    def _side_by_side(self, dealt: DataFrame, compare, schema: str) -> DataFrame:
        """The sets of dealt pairs, made from the texts, through `compare`."""
        return (
            self.documents.join(few(dealt), "id")  # if it is not few, the texts of all documents are shuffled to meet it
            .select("lead", "salt", "id", "text")
            .mapInArrow(_set_rows(self.n), "lead long, salt long, id long, grams binary")
            .repartition("lead", "salt")
            .sortWithinPartitions("lead", "salt", F.col("id") != F.col("lead"), "id")
            .mapInArrow(compare, schema)
        )

    def verify(self, pairs: DataFrame, percent: int) -> DataFrame:
        """(a, b, both, size_a, size_b) of the pairs that may reach `percent`; a pair comes once."""
        likely = self._likely(pairs, percent)
        dealt = self._dealt(likely)
        both = self._side_by_side(dealt, _overlaps, "a long, b long, both long")
        out = staged(likely.join(both, ["a", "b"]), "verified")
        release(likely, dealt)
        return out

    def links(self) -> DataFrame:
        """Pairs (a, b) of representatives with enough overlap, such that all linked ones are connected."""
        percent = self.percent
        near = percent - NEAR
        far = near - (100 - percent)
        shared = [self._shared(self.postings)]
        rare = shared[0].where(f"n <= {FEW}").select("gram", "id", "size", "pos")
        pairs = (
            rare.alias("x").join(rare.alias("y"), F.expr("x.gram = y.gram AND x.id < y.id")).where(_may_link(percent))
            .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        )
        linked, close = [self.verify(pairs, percent).where(_similar(percent)).select("a", "b")], []
        for turn in range(ROUNDS):
            if turn:
                shared.append(self._shared(live))
            led = shared[-1] if turn else shared[0].where(f"n > {FEW}")
            if led.isEmpty():
                break
            # a member meets its leader at the first n-gram they share, not at each of them
            first = led.where("id <> lead").groupBy("lead", "id").agg(F.min(F.struct("pos", "gram", "size")).alias("first"))
            pairs = (
                led.where("id = lead").alias("x")
                .join(first.select("lead", "id", "first.*").alias("y"), F.expr("x.id = y.lead AND x.gram = y.gram"))
                .where(_may_link(far))
                .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
            )
            found = self.verify(pairs, far)
            linked.append(found.where(_similar(percent)).select("a", "b"))
            close.append(found.where(_similar(far)))
            # a member near its leader meets the others there; distances of linked ones differ by a margin at most
            met = found.where(_similar(near)).select(F.col("a").alias("lead"), F.col("b").alias("id"))
            live = led.where("id <> lead").select("gram", "id", "size", "pos", "lead").join(met, ["lead", "id"], "left_anti").drop("lead")
        linked = staged(reduce(DataFrame.union, linked).distinct(), "linked")
        if not close:
            release(*shared)
            return linked
        label = components(linked).select("id", F.col("component").alias("comp"))
        placed = self._shared(live).drop("lead", "n").join(label, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        rest = staged(placed, "rest")
        release(*shared)
        apart = (
            rest.alias("x").join(rest.alias("y"), F.expr("x.gram = y.gram AND x.id < y.id AND x.comp <> y.comp"))
            .where(_may_link(percent)).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        )
        around = reduce(DataFrame.union, [self._around_leader(found, label) for found in close])
        more = self.verify(apart.union(around), percent).where(_similar(percent)).select("a", "b")
        return linked.union(more)

    def _around_leader(self, found: DataFrame, label: DataFrame) -> DataFrame:
        """Pairs of members near one leader, of different classes, that may link.

        Sets differ from each other by the symmetric difference of their differences from the leader.
        Two that link differ by at most D = (|x| + |y|) (1 - t) / (1 + t) n-grams; then, of the first D + 1
        n-grams by which one differs from the leader, in any order, the other shares one, unless the
        leader connects the two. Differences that few members share come first, so members that differ
        each in its own way never meet.
        """
        rest = 100 - self.percent
        classed = label.withColumnRenamed("id", "b")
        members = found.join(classed, "b", "left").withColumn("comp", F.coalesce("comp", "b"))
        leads = label.select(F.col("id").alias("a"), F.col("comp").alias("lead_comp"))
        members = members.join(leads, "a", "left").withColumn("lead_comp", F.coalesce("lead_comp", "a"))
        strange = members.where("comp <> lead_comp").groupBy("a").agg(F.min("comp").alias("_low"))
        members = staged(members.join(strange, "a", "left_semi").select("a", "b", "size_a", "size_b", "comp"), "members")
        dealt = self._dealt(members.select("a", "b"))
        grams = self._side_by_side(dealt, _differences, "lead long, id long, grams array<long>")
        rows = staged(grams.select("lead", "id", F.size("grams").alias("far"), F.explode("grams").alias("gram")), "differences")
        release(dealt)
        shared = rows.groupBy("lead", "gram").agg(F.count("*").alias("n")).where("n > 1")
        common = rows.join(shared, ["lead", "gram"])
        ranked = common.withColumn("own", F.col("far") - F.count("*").over(Window.partitionBy("lead", "id"))).withColumn(
            "pos", F.col("own") + F.row_number().over(Window.partitionBy("lead", "id").orderBy("n", "gram"))
        )
        sizes = members.select(F.col("a").alias("lead"), F.col("b").alias("id"), F.col("size_b").alias("size"), "comp")
        # the largest partner has size / t n-grams
        reach = f"size * {rest} div {self.percent} + 1"
        heads = ranked.join(sizes, ["lead", "id"]).where(f"pos <= {reach}").select(
            "lead", "gram", "id", "size", "comp", (F.col("pos") - F.col("own") - 1).alias("before"), (F.col("far") - F.col("pos")).alias("after"), "far"
        )
        mixed = heads.groupBy("lead", "gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
        heads = staged(heads.join(mixed, ["lead", "gram"], "left_semi"), "heads")
        return (
            heads.alias("x")
            .join(heads.alias("y"), F.expr("x.lead = y.lead AND x.gram = y.gram AND x.id < y.id AND x.comp <> y.comp"))
            .where(f"100 * least(x.size, y.size) >= {self.percent} * greatest(x.size, y.size)")
            # the shared n-gram and what both have before and after it bound how much the differences overlap
            .where(
                f"""{100 + self.percent} * (x.far + y.far - 2 * (1 + least(x.before, y.before) + least(x.after, y.after)))
                    <= {rest} * (x.size + y.size)"""
            )
            .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        )


def jaccard_classes(documents: DataFrame, key: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90) -> DataFrame:
    """(key, n_shingles, component_id) of every row; the class is the least key reachable by links.

    Two documents link when 100 * intersection >= percent * union of their n-gram sets, exactly. Null
    texts and texts without words have size 0 and are their own class. Rows of a null key have null
    as class. Repeated keys are one document each time; a key whose texts differ belongs to the
    classes' least id of each text. Extra columns are not read; an empty table gives an empty one.
    """
    prepare(documents.sparkSession)
    rows = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    join = Join(rows, n, percent)
    label = components(join.links())
    release(join.reps)
    reps = join.classes.join(label, join.classes["rep"] == label["id"], "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id")
    )
    full, empty = join.signed.where("size > 0"), join.signed.where("size = 0")
    return (
        full.join(reps, "digest", "left")
        .select(F.col("id").alias(key), F.col("size").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
        .unionByName(empty.select(F.col("id").alias(key), F.col("size").alias("n_shingles"), F.col("id").alias("component_id")))
    )


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of which the key is the least of its class, all their columns.

    Rows of a null key, and rows without words, stay. Where a key is repeated, all its rows stay or go.
    """
    classes = staged(jaccard_classes(documents, key, text, n, percent), "classes")
    gone = staged(classes.where(F.col(key) != F.col("component_id")).select(F.col(key).alias("_gone")).distinct(), "gone")
    release(classes)
    gone = few(gone)
    return documents.join(gone, documents[key] == gone["_gone"], "left_anti")
