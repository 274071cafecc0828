"""N-gram Jaccard join by vertical partitioning, and the components that its links make.

Every set of word shingles is sorted in one global order, which is cut into fragments. Partial counts are made fragment by
fragment, each in its own tasks, and summed per set or per pair:

1. Equal sets become one class. Of each class the first shingles in hash order (enough that two linked sets share several) are
   counted by fragment; a class too few of whose shingles are in any other class has no link (`census`).
2. The whole sets of the classes that remain are counted likewise. Shingles that are in one class alone are only counted; the
   others are ordered by frequency, so a set's prefix holds its rarest ones.
3. Linked sets share a shingle of their prefixes. Instead of all pairs of a shingle's classes, each class is compared with the
   shingle's leader, the one with the fewest rarer shingles (`stars`). Overlaps are summed over fragments (`overlaps`).
4. Two classes that are near the same leader share |leader| - |missing| - |missing'| + (common differences) shingles. If they
   are linked and not both linked to the leader, they have a difference to it in common: so those pairs come from an index of
   differences (`beside`). Classes far from their leader choose another one, round by round, while that halves the pairs that
   are left; then those are compared, as a rule no more than PAIRS a row. Only where a prefix's shingle is in many classes
   that are far from each other are there more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import few, in_arrow, join_dealt, remove, scratch, table, unused, written

WIDTH, PERCENT = 3, 90
#: Shingles beyond the least prefix that step 1 looks at, as a share of the set: two linked sets share so many and one more.
MORE = 0.05
#: Shingles that a task counts, and that a message to it is made from.
FRAGMENT, BATCH = 500_000, 500_000
#: Fragments in which pairs are compared; pairs for each row of postings up to which the rest is compared pairwise.
PARTS, PAIRS = 4, 2
#: Survivors whose ids are broadcast; beyond that they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Facts that are broadcast to the rows that they are joined to, and shingles of sets that are; beyond that rows are dealt and
#: moved. A broadcast is one exchange, where dealing takes four: Spark's driver has a thread for each, and keeps it for a minute.
FACTS, SHINGLES = 100_000, 1_000_000
#: Jaccard distance in percent within which a class is done with a leader. By the triangle inequality what is linked to such a
#: class lies around the leader, within NEAR and the links' own distance.
NEAR = 25


def least(n, percent: int = PERCENT):
    """The fewest shingles that a set of n shares with any set it is linked to."""
    return -(-n * percent // 100)


def looked_at(n: np.ndarray, percent: int) -> np.ndarray:
    return np.minimum(n, n - least(n, percent) + 1 + (MORE * n).astype(np.int64))


def shingle_sets(docs: DataFrame, width: int, percent: int, whole: bool) -> DataFrame:
    """sig (128 bits of the set), n, hashes (the set in hash order, or what step 1 looks at) and doc_id of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in tokens.parts(b.column("text")):
                found = tokens.words(part)
                h = tokens.word_hashes(part, found)
                cut = np.searchsorted(found.doc, np.arange(part.docs + 1))
                sets = [np.unique(tokens.shingle_hashes(h[a:z], width)) for a, z in zip(cut, cut[1:], strict=False)]
                n = np.array([len(s) for s in sets], np.int64)
                few = n if whole else looked_at(n, percent)
                ids = b.column("doc_id").slice(part.rows.start, part.docs)
                sigs = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays([ids, pa.array(sigs, pa.binary()), pa.array(n), pa.array([s[:k].tobytes() for s, k in zip(sets, few, strict=True)], pa.binary())], names=["doc_id", "sig", "n", "hashes"])

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, "doc_id long, sig binary, n long, hashes binary")


MESSAGE = "fragment int, batch string, hashes binary, kinds binary, times binary, inverse binary, sizes binary, sigs binary, n binary"


def cut_up(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """`values` as binary values that end where `ends` says, each from the end of the one before."""
    offsets = np.concatenate([[0], ends]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype("<i4")), pa.py_buffer(values)])


def size_kinds(n: np.ndarray, percent: int) -> np.ndarray:
    """Kinds of set sizes, 1 to 254: sets that can be linked are of one kind or of neighbouring ones."""
    width = max(np.log(100 / max(percent, 1)) * (1 + 1e-6), 0.1)
    return np.minimum(1 + np.floor(np.log(np.maximum(n, 1)) / width), 254).astype(np.uint8)


def distinct(hashes: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of hash and kind in order, how often each comes, and the place of every given pair among them."""
    order = np.lexsort((kinds, hashes))
    h, k = hashes[order], kinds[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (k[1:] != k[:-1])
    inverse = np.empty(len(h), np.int64)
    inverse[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    return h[at], k[at], np.diff(np.append(at, len(h))).astype("<u4"), inverse


def census(sets: DataFrame, fragments: int, percent: int, whole: bool, sized: bool = False) -> DataFrame:
    """sig, n, unique (shingles that no other set has) and, if whole, shared: the others by frequency, then hash;
    shared is null where too many shingles are unique for any link. If `sized`, a shingle is unique as well when only sets have it
    whose sizes rule out a link: linked sets still share all that they have in common, and any two sets share no more.

    A batch of sets sends each of its distinct hashes once for each kind of size, with its count, to the fragment of the hash,
    as its first 32 bits there (a rare clash makes two shingles shared, which costs a comparison and changes no link); what only
    concerns the batch (which set has which hashes) goes by the batch's name. Fragments answer each batch with the hashes' frequencies.
    So a shingle that very many sets share costs its fragment a number for each batch and kind. A message has a hash at least: there are never
    more of them than hashes, and as a batch grows no further, that is what they come to where batches and fragments are very many.
    """
    step = (1 << 64) // fragments + 1
    spare = max(0, (step - 1).bit_length() - 32)

    def batches_of(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum(pc.binary_length(rows.column("hashes")).to_numpy(zero_copy_only=False) // 8)
        at = 0
        while at < rows.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH, "right")))
            yield rows.slice(at, end - at)
            at = end

    def told_apart(hashes: np.ndarray, n: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        kinds = size_kinds(n, percent) if sized else np.ones(len(n), np.uint8)
        return distinct(hashes, np.repeat(kinds, sizes))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("fragment", pa.int32()), ("batch", pa.string()), *((c, pa.binary()) for c in ("hashes", "kinds", "times", "inverse", "sizes", "sigs", "n"))])
        for rows in (x for b in batches for x in batches_of(b)):
            sigs, parts = rows.column("sig").to_pylist(), rows.column("hashes").to_pylist()
            joined = b"".join(sigs)
            name = hashlib.blake2b(joined, digest_size=12).hexdigest()
            given, n, sizes = np.frombuffer(b"".join(parts), "<u8"), np.array(rows.column("n").to_pylist(), "<u4"), np.array([len(p) // 8 for p in parts], "<u4")
            hashes, kinds, times, inverse = told_apart(given, n, sizes)
            at = np.searchsorted(hashes // np.uint64(step), np.arange(fragments + 1, dtype=np.uint64))
            to = np.flatnonzero(np.diff(at))
            short = (hashes % np.uint64(step) >> np.uint64(spare)).astype("<u4")
            nothing = pa.nulls(len(to), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.repeat(name, len(to)), *(cut_up(v, at[to + 1]) for v in (short, kinds, times)), *[nothing] * 4], schema=schema)
            own = (fragments + int(name[:8], 16) % fragments, name, given.tobytes() if whole else None, None, None, None if whole else inverse.astype("<u4").tobytes(), sizes.tobytes(), joined, n.tobytes())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, own, strict=True))], schema)

    def count(t: pa.Table) -> pa.Table:
        if t.column("times").null_count:  # batches' own rows pass
            return t
        hashes, kinds, times = (np.frombuffer(b"".join(t.column(c).to_pylist()), kind) for c, kind in (("hashes", "<u4"), ("kinds", "u1"), ("times", "<u4")))
        keys, inverse = np.unique(hashes.astype(np.uint64) << np.uint64(8) | kinds, return_inverse=True)
        each = np.bincount(inverse, times, len(keys))
        near = each.copy()
        beside = np.flatnonzero(np.diff(keys) == 1)  # the same hash with neighbouring kinds, as no kind is 0
        near[beside] += each[beside + 1]
        near[beside + 1] += each[beside]
        of_hash = np.cumsum(np.diff(keys >> np.uint64(8), prepend=keys[:1] >> np.uint64(8)) != 0)
        total = np.bincount(of_hash, each)[of_hash]
        answers = cut_up(np.where(near == 1, 1, total)[inverse].astype("<u4"), np.cumsum(pc.binary_length(t.column("kinds")).to_numpy()))
        nothing = pa.nulls(t.num_rows, pa.binary())
        return pa.table([t.column("fragment"), t.column("batch"), nothing, nothing, answers, *[nothing] * 4], names=t.column_names)

    def gather(t: pa.Table) -> pa.Table:
        answers = pc.is_null(t.column("sizes"))
        own = t.filter(pc.invert(answers)).to_pylist()[0]
        said = t.filter(answers).select(["fragment", "times"]).sort_by("fragment")
        times = np.frombuffer(b"".join(said.column("times").to_pylist()), "<u4")
        sizes, n = np.frombuffer(own["sizes"], "<u4").astype(np.int64), np.frombuffer(own["n"], "<u4").astype(np.int64)
        values = np.frombuffer(own["hashes"], "<u8") if whole else None
        frequency = times[told_apart(values, n, sizes)[3] if whole else np.frombuffer(own["inverse"], "<u4")]
        ends = np.cumsum(sizes)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        unique = np.bincount(doc, frequency == 1, minlength=len(sizes)).astype(np.int64)
        shared = [None] * len(sizes)
        if whole:
            for i in np.flatnonzero(unique <= n - least(n, percent)):
                here = slice(ends[i] - sizes[i], ends[i])
                f, v = frequency[here], values[here]
                many = f > 1
                shared[i] = v[many][np.lexsort((v[many], f[many]))].view("<i8")
        sigs = [own["sigs"][16 * i : 16 * i + 16] for i in range(len(sizes))]
        return pa.table([pa.array(sigs, pa.binary()), pa.array(n), pa.array(unique), pa.array(shared, pa.list_(pa.int64()))], names=["sig", "n", "unique", "shared"])

    sent = in_arrow(sets, send, MESSAGE)
    counted = sent.groupBy("fragment").applyInArrow(count, MESSAGE)
    return counted.groupBy("batch").applyInArrow(gather, "sig binary, n long, unique long, shared array<long>")


def linked(overlap: Column, n: Column, m: Column, percent: int) -> Column:
    return overlap * 100 >= (n + m - overlap) * percent


def with_facts(rows: DataFrame, facts: DataFrame, on: list[str], most: int, total: Callable[[], int], how: str = "inner", by: Column | None = None, counts: DataFrame | None = None) -> DataFrame:
    """`join_dealt`, of `total()` rows, or a broadcast while there are no more facts than FACTS; there are `most` of them, or fewer."""
    return rows.join(F.broadcast(facts), on, how) if most <= FACTS else join_dealt(rows, facts, on, total(), how, by, counts)


def among(cores: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `cores` whose sig is among `ids`: what isn't asked for is left where it is."""
    return cores.join(few(ids.toDF("sig").distinct(), BROADCAST_ROWS), "sig", "left_semi")


def sets_of(rows: DataFrame, end: str, cores: DataFrame) -> DataFrame:
    """The sets, h and the end's name, at one end of the rows, broadcast: for rows whose sets have no more than SHINGLES together."""
    asked = F.broadcast(rows.select(F.col(end).alias("sig")))
    return F.broadcast(cores.join(asked, "sig", "left_semi").select(F.col("sig").alias(end), F.col("shared").alias(f"h{end}")))


def overlaps(spark: SparkSession, pairs: DataFrame, cores: DataFrame) -> DataFrame:
    """Adds overlap to pairs (x, nx, y, ny): counted in each part of the order, summed per pair. Pairs of one y are dealt."""
    pairs = written(spark, pairs, "jaccard-pairs")
    many, shingles = pairs.agg(F.count("*"), F.sum(F.col("nx") + F.col("ny"))).first()
    if (shingles or 0) <= SHINGLES:
        found = pairs.join(sets_of(pairs, "y", cores), "y").join(sets_of(pairs, "x", cores), "x")
        return found.select("x", "nx", "y", "ny", F.size(F.array_intersect("hx", "hy")).cast("long").alias("overlap"))
    part = lambda k: F.filter("shared", lambda h: F.pmod(h, F.lit(PARTS)) == k)
    cut = among(cores, pairs.select("x").union(pairs.select("y"))).select("sig", F.posexplode(F.array(*[part(k) for k in range(PARTS)])).alias("part", "hashes"))
    each = pairs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    found = join_dealt(each, cut.withColumnsRenamed({"sig": "y", "hashes": "hy"}), ["y", "part"], PARTS * many, by=F.xxhash64("x"))
    found = found.join(cut.withColumnsRenamed({"sig": "x", "hashes": "hx"}), ["x", "part"])
    partial = found.select("x", "nx", "y", "ny", F.size(F.array_intersect("hx", "hy")).cast("long").alias("overlap"))
    return partial.groupBy("x", "nx", "y", "ny").agg(F.sum("overlap").alias("overlap"))


def stars(spark: SparkSession, postings: DataFrame, rows: int) -> DataFrame:
    """hash, x, nx, px and its leader y, ny, py: of the classes that have the hash the one with the fewest rarer shingles. Postings of one hash are dealt."""
    leader = postings.groupBy("hash").agg(F.min(F.struct("px", "x", "nx")).alias("leader"), F.count("*").alias("count")).filter("count > 1")
    leader = written(spark, leader, "jaccard-leaders")
    found = with_facts(postings, leader.drop("count"), ["hash"], rows // 2, lambda: rows, by=F.xxhash64("x"), counts=leader)
    return found.select("hash", "x", "nx", "px", F.col("leader.x").alias("y"), F.col("leader.nx").alias("ny"), F.col("leader.px").alias("py"))


def pairs_left(postings: DataFrame) -> tuple[int, int]:
    """Rows of postings, and pairs that they make within hashes."""
    n = F.col("count")
    return tuple(x or 0 for x in postings.groupBy("hash").count().agg(F.sum(n), F.sum(n * (n - 1) / 2).cast("long")).first())


def may_link(percent: int) -> Column:
    """Whether two sets with a common shingle at places px and py, nothing common before, can be linked at all."""
    most = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))
    return linked(most, F.col("nx"), F.col("ny"), percent)


def beside(near: DataFrame, cores: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) between classes near the same leader, from an index of their differences to it.

    near: x, nx, y (the leader), ny, component, outside of classes around leaders that have some class near them but outside of
    their component. Of two classes in different components one is outside: so those are joined with all.
    """
    many, shingles = near.agg(F.count("*"), F.sum(F.col("nx") + F.col("ny"))).first()
    if (shingles or 0) <= SHINGLES:
        full = near.join(sets_of(near, "y", cores), "y").join(sets_of(near, "x", cores), "x")
    else:
        a, b = (among(cores, near.select(c)).select(F.col("sig").alias(c), F.col("shared").alias(f"h{c}")) for c in ("x", "y"))
        full = join_dealt(near, b, ["y"], many, by=F.xxhash64("x")).join(a, "x")
    full = full.select("x", "nx", "y", "component", "outside", F.size("hy").alias("whole"), F.array_except("hy", "hx").alias("missing"), F.array_except("hx", "hy").alias("extra"))
    of = lambda name, kind: F.transform(name, lambda h: F.struct(F.lit(kind).alias("kind"), h.alias("hash")))
    rows = full.select("x", "nx", "y", "component", "outside", "whole", F.size("missing").alias("lost"), F.size("extra").alias("gained"), F.explode(F.concat(of("missing", 0), of("extra", 1))).alias("difference"))
    other = rows.select("y", "difference", F.col("x").alias("x2"), F.col("nx").alias("nx2"), F.col("component").alias("component2"), F.col("outside").alias("outside2"), F.col("lost").alias("lost2"), F.col("gained").alias("gained2"))
    n, m = F.col("nx"), F.col("nx2")
    base = F.col("whole") - F.col("lost") - F.col("lost2")
    most = F.least("lost", "lost2") + F.least("gained", "gained2")  # no two classes have more differences in common
    once = ~F.col("outside2") | (F.col("x") < F.col("x2"))
    pairs = rows.filter("outside").join(other, ["y", "difference"]).filter(once & (F.col("component") != F.col("component2")) & linked(F.least(base + most, n, m), n, m, percent))
    same = pairs.groupBy("y", "x", "nx", "x2", "nx2", "whole", "lost", "lost2").agg(F.count("*").alias("same"))
    return same.filter(linked(base + F.col("same"), n, m, percent)).select("x", F.col("x2").alias("y"))


def both_ways(pairs: DataFrame) -> DataFrame:
    ends = F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    return pairs.filter("x != y").select(F.explode(ends).alias("ends")).select("ends.x", "ends.y").distinct()


def renamed(pairs: DataFrame, labels: DataFrame, most: int, total: Callable[[], int]) -> DataFrame:
    """Pairs (x, y) of the components that `labels` (sig, component; at most `most`) has for them. Pairs of one x, or one y, are dealt."""
    for end, other in (("x", "y"), ("y", "x")):
        found = labels.select(F.col("sig").alias(end), F.col("component").alias("renamed"))
        pairs = with_facts(pairs, found, [end], most, total, by=F.xxhash64(other)).select(F.col("renamed").alias(end), other)
    return pairs


def components(spark: SparkSession, labels: DataFrame, links: DataFrame, known: int | None = None) -> DataFrame:
    """`labels` (sig and component, the least sig of those joined so far; `known` rows) once `links` (x, y) join them.

    Links become edges between components, so what is joined already costs nothing. Each component with edges goes to the least of its
    neighbours, and with that one to its own least, until that is none's neighbour's; then edges are between what is left, and
    those inside one component are dropped. So an edge is read until its ends have met, not in all rounds.
    """
    known = labels.count() if known is None else known
    links = links.select("x", "y") if known <= FACTS else written(spark, links.select("x", "y"), "jaccard-new-links")
    edges = written(spark, both_ways(renamed(links, labels, known, links.count)), "jaccard-edges")
    steps = [(labels, known)]
    while many := edges.count():
        to = edges.groupBy(F.col("x").alias("sig")).agg(F.min("y").alias("y")).select("sig", F.least("sig", "y").alias("component"))
        to = written(spark, to, "jaccard-least")
        nodes, done = min(many, known), False
        while not done:
            after = to.select(F.col("sig").alias("component"), F.col("component").alias("after"))
            jumped = written(spark, with_facts(to, after, ["component"], nodes, to.count, by=F.xxhash64("sig")), "jaccard-jumped")
            done = jumped.filter("component != after").isEmpty()
            to = jumped.select("sig", F.col("after").alias("component"))
        steps.append((to, nodes))
        edges = written(spark, both_ways(renamed(edges.filter("x < y"), to, nodes, lambda many=many: many)), "jaccard-edges")
    (to, nodes), *before = reversed(steps)
    for labelled, more in before:
        after = to.select(F.col("sig").alias("component"), F.col("component").alias("after"))
        joined = with_facts(labelled, after, ["component"], nodes, labelled.count, how="left", by=F.xxhash64("sig"))
        to, nodes = joined.select("sig", F.coalesce("after", "component").alias("component")), more
    return written(spark, to, "jaccard-labels") if before else labels


def connected(spark: SparkSession, cores: DataFrame, percent: int) -> DataFrame:
    """sig and component of each class: classes are joined by links that connect all that any links connect, as every link is among
    them or inside a component of them."""
    least_n = F.ceil(F.col("n") * percent / 100)
    prefix = F.slice("shared", 1, (F.col("n") - least_n + 1 - F.col("unique")).cast("int"))
    postings = cores.select(F.col("sig").alias("x"), F.col("n").alias("nx"), F.posexplode(prefix).alias("place", "hash"), "unique").withColumn("px", F.col("place") + F.col("unique")).drop("place", "unique")
    postings = written(spark, postings, "jaccard-postings")
    where, known = cores.select("sig", F.col("sig").alias("component")), cores.count()
    links = none = spark.createDataFrame([], "x binary, y binary")
    around_percent = percent - NEAR
    before = None
    while True:
        rows, pairs = pairs_left(postings)
        if not rows:
            return components(spark, where, links, known)
        if pairs <= PAIRS * rows or before and 2 * pairs > before:
            break
        before = pairs  # each round every hash loses its leader at least, and the classes that are near it
        star = written(spark, stars(spark, postings, rows), "jaccard-stars")
        pairs = star.filter(F.col("x") != F.col("y")).filter((F.col("nx") * 100 >= F.col("ny") * around_percent) & (F.col("ny") * 100 >= F.col("nx") * around_percent)).select("x", "nx", "y", "ny").distinct()
        compared = written(spark, overlaps(spark, pairs, cores), "jaccard-compared")
        where = components(spark, where, links.union(compared.filter(linked(F.col("overlap"), F.col("nx"), F.col("ny"), percent)).select("x", "y")), known)
        # Very many classes can have one leader.
        leads = where.select(F.col("sig").alias("y"), F.col("component").alias("leads"))
        leads = leads if known <= FACTS else leads.join(compared.select("y").distinct(), "y", "left_semi")
        around = compared.filter(linked(F.col("overlap"), F.col("nx"), F.col("ny"), around_percent))
        around = with_facts(around, leads, ["y"], known, compared.count, by=F.xxhash64("x"))
        own = where.withColumnRenamed("sig", "x")
        around = around.join(F.broadcast(own) if known <= FACTS else own, "x")
        around = written(spark, around.withColumn("outside", F.col("component") != F.col("leads")), "jaccard-around")
        open_ = around.filter("outside").select("y").distinct()
        near = with_facts(around, open_, ["y"], known, compared.count, by=F.xxhash64("x")).select("x", "nx", "y", "ny", "component", "outside")
        near = written(spark, near, "jaccard-near")
        links = none if near.isEmpty() else written(spark, beside(near, cores, percent), "jaccard-links")
        done = compared.filter(linked(F.col("overlap"), F.col("nx"), F.col("ny"), 100 - NEAR)).select("x", "y")
        rest = star.filter(F.col("x") != F.col("y")).join(done, ["x", "y"], "left_anti").select("x", "nx", "hash", "px")
        postings = written(spark, rest, "jaccard-postings")
    where = components(spark, where, links, known)
    own = where.withColumnRenamed("sig", "x")
    left = postings.join(F.broadcast(own) if known <= FACTS else own, "x")
    right = left.select("hash", F.col("x").alias("y"), F.col("nx").alias("ny"), F.col("px").alias("py"), F.col("component").alias("component2"))
    pairs = left.join(right, "hash").filter((F.col("x") < F.col("y")) & (F.col("component") != F.col("component2")) & may_link(percent)).select("x", "nx", "y", "ny").distinct()
    compared = overlaps(spark, pairs, cores).filter(linked(F.col("overlap"), F.col("nx"), F.col("ny"), percent))
    return components(spark, where, written(spark, compared.select("x", "y"), "jaccard-links"), known)


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row (doc_id, text); links are exact up to 64-bit hashes of shingles.

    Rows link whose sets have 100 * intersection >= percent * union. A null or empty text, and one without words, has no
    shingles and is its own component; fewer than `width` words are one shingle. Repeated rows are equal sets and link.
    component_id is the least doc_id of the component, ignoring null ones; it is null where all are. Other columns are
    ignored; an empty table gives no rows.
    """
    sets_at, classes_at = scratch(spark, "jaccard-sets"), scratch(spark, "jaccard-classes")
    shingle_sets(docs, width, percent, whole=False).write.parquet(sets_at)
    sets = spark.read.parquet(sets_at)
    rows = written(spark, sets.drop("hashes"), "jaccard-rows")
    sets.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"), F.max("hashes").alias("hashes")).write.parquet(classes_at)
    remove(spark, sets_at)
    classes = spark.read.parquet(classes_at)
    firsts = written(spark, classes.drop("hashes"), "jaccard-firsts")
    total = classes.agg(F.sum(F.octet_length("hashes"))).first()[0] or 0
    counts = census(classes.select("sig", "n", "hashes"), max(8, -(-total // 8 // FRAGMENT)), percent, whole=False, sized=True)
    n = F.col("n")
    more = lambda c: F.floor(c * MORE).cast("long")
    seen = F.least(n, n - F.ceil(n * percent / 100) + 1 + more(n))
    survivors = counts.filter(seen - F.col("unique") >= 1 + more(F.ceil(n * percent / 100))).select("sig")
    survivors = written(spark, survivors.join(firsts, "sig"), "jaccard-survivors")
    remove(spark, classes_at)
    many, total = survivors.agg(F.count("*"), F.sum("n")).first()
    few = (lambda x: F.broadcast(x)) if many <= BROADCAST_ROWS else (lambda x: x)
    ids = survivors.select(F.col("first").alias("id")).distinct()
    again = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(few(ids), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    whole = shingle_sets(again, width, percent, whole=True).join(few(survivors.select("sig")), "sig", "left_semi")
    cores = census(whole.select("sig", "n", "hashes"), max(8, -(-(total or 0) // FRAGMENT)), percent, whole=True, sized=True).filter("shared is not null").dropDuplicates(["sig"])
    cores = written(spark, cores, "jaccard-cores")
    where = connected(spark, cores, percent)
    facts = (lambda x: F.broadcast(x)) if many <= FACTS else (lambda x: x)
    named = written(spark, facts(where).join(firsts.select("sig", "first"), "sig"), "jaccard-named")
    first = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_core = with_facts(named, first, ["component"], many, lambda: many, by=F.xxhash64("sig")).select("sig", "component_id")
    of_class = written(spark, firsts.select("sig", "first").join(facts(of_core), "sig", "left").select("sig", F.coalesce("component_id", "first").alias("component_id")), "jaccard-components")
    # Rows of no words are left out of the join, those of one set are dealt.
    some, none = rows.filter("n > 0").select("doc_id", "n", "sig"), rows.filter("n = 0").select("doc_id", "n")
    out = join_dealt(some, of_class, ["sig"], rows.count(), by=F.xxhash64("doc_id")).unionByName(none, allowMissingColumns=True)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by a Jaccard similarity of 0.9 or more of their 3-word shingles."""
    return near_duplicates(spark, table(spark, sf_dir, "documents"))


def keyed(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a further column, and its name: a long that no two rows share, doc_id where all rows have one of their own.

    Else rows are numbered in the order of doc_id (null ones last) and the digest of their text, and written with their numbers.
    """
    doc_id, key = F.col("doc_id").cast("long"), unused(docs.columns, "row key")
    if docs.groupBy(doc_id.alias("id")).count().filter("id is null or count > 1").isEmpty():
        return docs.withColumn(key, doc_id), key
    ordered = docs.orderBy(doc_id.asc_nulls_last(), F.sha2(F.coalesce("text", F.lit("")), 256))
    return written(spark, ordered.withColumn(key, F.monotonically_increasing_id()), "jaccard-keyed"), key


def by_key(rows: DataFrame, key: str) -> DataFrame:
    """Keyed rows with their key for doc_id."""
    return rows.withColumn("doc_id", F.col(f"`{key}`")).drop(key)


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The keyed rows whose key isn't among the doc_ids of `gone`, less the key: a broadcast while those are few, else a shuffle."""
    gone = gone.select(F.col("doc_id").alias(key)).distinct()
    return docs.join(few(gone, BROADCAST_ROWS), key, "left_anti").select(*(f"`{c}`" for c in docs.columns if c != key))


def one_of_each(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, with all their columns, less those whose component has a row of smaller key: one row of each component stays."""
    docs, key = keyed(spark, docs)
    found = written(spark, near_duplicates(spark, by_key(docs, key), width, percent), "jaccard-found")
    return without(docs, found.filter("doc_id != component_id"), key)
