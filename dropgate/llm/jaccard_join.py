"""Set-similarity join on word n-grams by vertical partitioning.

The global order of the n-grams is the order of their 64-bit hashes, cut into fragments.

* Candidates.  Two sets with Jaccard similarity >= t differ in at most D = floor(n (1 - t) / t) n-grams, n being the
  smaller size.  Cut into more than D non-empty fragments, the larger number stays untouched, so a linked pair
  shares the content of several fragments.  Each set has one signature per fragment: (size class, fragment, hash of the
  n-grams in it).  Frequent n-grams or passages make no group by themselves, as a fragment holds several n-grams.
  A set with too few non-empty fragments also has its prefix in the global order as a signature.  Of a set's signatures, the D + 1
  shared by the fewest sets find every linked partner; fragments that no other set has count as differences.  A sketch of
  parities (each n-gram flips one bit) bounds the differences of two sets from below: pairs beyond D are not counted.
* Overlaps.  A candidate pair is counted fragment by fragment (ranges of the order with at most about ``WIDTH``
  n-grams of a set); the partial overlaps are summed per pair.

Groups of sets that share a signature are never expanded into all pairs.  Equal sets are one node from the start, and a task sends
a signature once however many of its sets have it.  In each round some members of a group are pivots (the most central one, then
8, 64, ... more, by hash) and are counted against members of other components; linked ones merge.  A group inside one
component needs no more work.  The rounds end when no group spans two components or every member has been a pivot, so no
link between components is lost: the result is exact.

Defined results: null or empty text, or text without words: n_shingles 0, linked with nothing, component of its own.
Fewer words than n: the whole sequence is the one n-gram.  Repeated rows and ids are linked like any others; a null id
is never the smallest unless all are null.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, by_batch, discard, list_array, mix, scratch, semi_join, store
from .components import components

#: n-grams of a set in a range of the global order whose overlap is counted at once, about (a power of two)
WIDTH = 4096
#: most 64-bit words of a sketch of parities; smaller sets have one for every 32 n-grams
SKETCH = 8
#: members of a group that have been pivots after the rounds: the central one, about 8, 72, ...: that many times as many
GROWTH = 8

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted distinct hashes of the word n-grams of a text, A-Z lower-cased."""
    if not text:
        return np.empty(0, np.uint64)
    split = text.encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, split), np.uint64, len(split))
    size = min(n, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = mix(out * _M1 + h[i : len(h) - size + 1 + i])
    return np.unique(out)


def differences(n: int, percent: int) -> int:
    """The most n-grams in which a set of size n can differ from a linked one that is not smaller."""
    return n * (100 - percent) // percent


def size_classes(n: int, percent: int) -> list[int]:
    """Classes (powers of two) in which a set of size n meets linked sets: its own, and the lower one if they reach there."""
    own = n.bit_length() - 1
    return [own, own - 1] if own and n * percent < 100 * (1 << own) else [own]


def signatures(s: np.ndarray, c: int, percent: int) -> tuple[np.ndarray, int, list[int]]:
    """Signatures of a sorted set of hashes in a size class, how many fragments they stand for, and a sketch.

    A signature is 42 bits of hash, the fragment modulo 64, the class, and 1 for a prefix.  The sketch has a bit mask of
    the fragments (modulo 64), then the parities: how many n-grams fall on each bit, modulo 2.  One n-gram more or less flips one
    bit, so two sets differ in at least as many n-grams as their parities in bits.
    """
    k = differences((2 << c) - 1, percent)
    k += 2 + k // 8
    cut = ((s >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)  # k ranges of the global order
    first = np.flatnonzero(np.r_[True, cut[1:] != cut[:-1]])
    at = cut[first]
    sizes = np.diff(np.r_[first, len(s)]).astype(np.uint64)
    each = mix(s ^ _M2)
    h = mix(np.add.reduceat(each, first) + mix(at + sizes * _M1))
    low = np.uint64(c << 1)
    sigs = ((h >> np.uint64(22)) << np.uint64(13)) | ((at & np.uint64(63)) << np.uint64(7)) | low
    sketch = [int(np.bitwise_or.reduce(np.uint64(1) << (at & np.uint64(63))))]
    bits = 64 * min(SKETCH, max(1, (1 << c) // 32))
    odd = np.bincount((each & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    sketch += np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64).tolist()
    most = differences(min((2 << c) - 1, len(s)), percent)
    if len(first) <= most:  # too few fragments to be sure: the prefix is
        prefix = mix(s[: most + 1])
        sigs = np.r_[sigs, ((prefix >> np.uint64(22)) << np.uint64(13)) | low | np.uint64(1)]
    return sigs, len(first), sketch


def _set_id(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) >> 1


def _signed64(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_SIGNED = pa.schema([
    ("id", pa.int64()), ("key", pa.int64()), ("node", pa.int64()), ("n", pa.int64()),
    ("classes", pa.list_(pa.struct([("class", pa.int32()), ("m", pa.int32()), ("sketch", pa.list_(pa.int64()))]))),
    ("sig", pa.int64()), ("lead", pa.bool_()), ("many", pa.bool_()),
])
_DDL = "id long, key long, node long, n long, classes array<struct<class:int,m:int,sketch:array<long>>>, sig long, lead boolean, many boolean"
_TOKENS = pa.schema([("node", pa.int64()), ("class", pa.int32()), ("fragment", pa.int32()), ("tokens", pa.list_(pa.int64()))])


def _signed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Two kinds of rows: one per document (id, key, node, n, classes), and one per signature and set of a task (sig, node).

    Of the sets of a task with the same signature, the first is its ``lead``; ``many`` says that there are others.
    """

    def run(batches):
        seen: set[int] = set()
        sigs: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                c = batch.slice(at, 512).to_pydict()
                ids, sizes, classes = [], [], []
                for s in (shingles(t, n) for t in c["text"]):
                    node, mine = None, None
                    if len(s):
                        node = _set_id(s)
                        if node not in seen:
                            seen.add(node)
                            mine = []
                            for k in size_classes(len(s), percent):
                                found, m, sketch = signatures(s, k, percent)
                                sigs.append(found)
                                nodes.append(np.full(len(found), node, np.int64))
                                mine.append({"class": k, "m": m, "sketch": [_signed64(x) for x in sketch]})
                    ids.append(node)
                    sizes.append(len(s))
                    classes.append(mine)
                none = pa.nulls(len(ids))
                columns = [pa.array(v, f.type) for v, f in zip((c["id"], c["key"], ids, sizes, classes), _SIGNED)]
                yield pa.RecordBatch.from_arrays([*columns, *(none.cast(f.type) for f in list(_SIGNED)[5:])], schema=_SIGNED)
        if not sigs:
            return
        sig, node = np.concatenate(sigs).view(np.int64), np.concatenate(nodes)
        del sigs, nodes
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        fresh = np.r_[True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])]
        sig, node = sig[fresh], node[fresh]
        lead = np.r_[True, sig[1:] != sig[:-1]]
        many = ~(lead & np.r_[lead[1:], True])
        for at in range(0, len(sig), 65536):
            part = slice(at, at + 65536)
            rows = len(sig[part])
            none = [pa.nulls(rows).cast(f.type) for f in list(_SIGNED)[:5]]
            none[2] = pa.array(node[part])
            yield pa.RecordBatch.from_arrays([*none, pa.array(sig[part]), pa.array(lead[part]), pa.array(many[part])], schema=_SIGNED)

    return docs.select("id", "key", "text").mapInArrow(run, _DDL)


def ranges(c: int) -> int:
    """Into how many ranges of the global order a set of class c is cut for counting."""
    return max(1, (1 << c) // (WIDTH // 2))


def _tokens(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, class, fragment, tokens) of the texts given, for each class in which the set meets others."""

    def make():
        seen: set[int] = set()

        def fn(c):
            ids, classes, fragments, parts = [], [], [], []
            for s in (shingles(t, n) for t in c["text"]):
                if not len(s) or (node := _set_id(s)) in seen:
                    continue
                seen.add(node)
                for k in size_classes(len(s), percent):
                    f = ranges(k)
                    cuts = np.array([(i << 64) // f for i in range(1, f)], np.uint64)
                    for i, part in enumerate(np.split(s, np.searchsorted(s, cuts))):
                        if len(part):
                            ids.append(node)
                            classes.append(k)
                            fragments.append(i)
                            parts.append(part)
            flat = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
            tokens = list_array(flat, np.array([len(x) for x in parts], np.int64), pa.int64())
            return {"node": ids, "class": classes, "fragment": fragments, "tokens": tokens}

        return fn

    found = docs.select("text").mapInArrow(by_batch(make, _TOKENS), "node long, class int, fragment int, tokens array<long>")
    return found.dropDuplicates(["node", "class", "fragment"])


def overlaps(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pairs (p, x, class) with the sum of their partial overlaps, counted fragment by fragment.

    The n-grams of x travel to those of p, once for each pair; p's are there once.
    """
    few = pairs.count() <= BROADCAST_ROWS
    mine = tokens.select(F.col("node").alias("x"), "class", "fragment", F.col("tokens").alias("of_x"))
    sent = mine.join(F.broadcast(pairs) if few else pairs, ["x", "class"])
    pivots = semi_join(tokens.withColumnRenamed("node", "p"), pairs.select("p").distinct(), "p").withColumnRenamed("tokens", "of_p")
    partial = sent.join(pivots, ["p", "class", "fragment"]).select("p", "x", "n_p", "n_x", F.size(F.array_intersect("of_p", "of_x")).alias("part"))
    return partial.groupBy("p", "x", "n_p", "n_x").agg(F.sum("part").alias("overlap"))


def linked(overlap: DataFrame, percent: int) -> DataFrame:
    return overlap.where(F.col("overlap") * 100 >= (F.col("n_p") + F.col("n_x") - F.col("overlap")) * percent)


def _class(sig: Column) -> Column:
    return F.shiftright(sig, 1).bitwiseAND(63).cast("int")


INDEX = ("sig", "node", "n", "class", "alone", "odd", "central", "size")


def _index(shared: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The signatures by which a set is found: (sig, node, n, class, alone, odd, central, size).

    ``alone`` masks the fragments no other set has; ``central`` tells how many sets share the others.
    """
    sizes = shared.groupBy("sig").agg(F.count("*").alias("size"))
    bit = F.expr("shiftleft(1L, cast(shiftright(sig, 7) & 63 as int))")
    rows = shared.join(sizes, "sig").withColumns({"class": _class(F.col("sig")), "prefix": F.col("sig").bitwiseAND(1) == 1, "bit": bit})
    of_set = Window.partitionBy("node", "class")
    rows = rows.withColumns({
        "place": F.row_number().over(of_set.orderBy("prefix", "size", "sig")),
        "met": F.count(F.when(~F.col("prefix"), 1)).over(of_set),
        "shared_mask": F.bit_or(F.when(F.col("prefix"), F.lit(0).cast("long")).otherwise(F.col("bit"))).over(of_set),
        "central": F.sum("size").over(of_set),
    }).join(nodes, ["node", "class"])
    most = F.expr(f"least(n, shiftleft(2L, class) - 1) * {100 - percent} div {percent}")
    found = F.col("prefix") | (F.col("place") <= most + 1 - (F.col("m") - F.col("met")))
    alone = F.col("sketch")[0].bitwiseAND(F.bitwise_not(F.col("shared_mask")))
    odd = F.slice("sketch", 2, SKETCH)
    return rows.where(found).withColumns({"alone": alone, "odd": odd}).select(*INDEX)


def _pairs(pivots: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """Pairs (p, x) of pivots and members of other components that share a signature and may be linked."""
    p = pivots.select("sig", *[F.col(c).alias(f"{c}_p") for c in ("node", "n", "comp", "alone", "odd")])
    least, greatest = F.least("n", "n_p"), F.greatest("n", "n_p")
    # at least so many n-grams differ; sets that meet are of one class, so their sketches have the same length
    alone = F.bit_count(F.col("alone").bitwiseOR(F.col("alone_p")))
    odd = F.lit(0)
    for i in range(SKETCH):
        odd = odd + F.coalesce(F.bit_count(F.get("odd", F.lit(i)).bitwiseXOR(F.get("odd_p", F.lit(i)))), F.lit(0))
    # J >= t means: the symmetric difference has at most (n + n_p) (1 - t) / (1 + t) n-grams
    allowed = (F.col("n") + F.col("n_p")) * (100 - percent)
    met = p.join(others, "sig").where(
        (F.col("comp_p") != F.col("comp")) & (least * 100 >= greatest * percent)
        & (alone * (100 + percent) <= allowed) & (odd * (100 + percent) <= allowed)
        & (~F.col("pivot") | (F.col("node_p") < F.col("node")))
    )
    # several signatures can lead to a pair, in two classes; the smaller set's own class is common to both
    common = F.length(F.bin(least)) - 1
    return met.select(F.col("node_p").alias("p"), F.col("node").alias("x"), "n_p", F.col("n").alias("n_x"), common.alias("class")).distinct()


def similar_sets(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """Rows of ``docs`` (id long, text string) as (id, key, n_shingles, component); key is the text's hash.

    Rows with equal sets, or sets chained by links, have one component: the smallest set id in it, null without words.
    """
    with scratch(docs.sparkSession) as keep:
        return keep(_similar_sets(docs.select("id", "text", F.xxhash64("text").alias("key")), n, percent))


def _similar_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    signed = store(_signed(docs, n, percent), "signed")
    members = store(signed.where("sig is null").select("id", "key", "node", "n"), "members")
    sigs = signed.where("sig is not null")
    group = Window.partitionBy("sig")
    leads = sigs.where("lead").select("sig", "node", "many").withColumns({"least": F.min("node").over(group), "most": F.max("node").over(group)})
    leads = leads.where("many or least <> most").select("sig", "node")
    shared = store(leads.unionByName(sigs.where("not lead").select("sig", "node")).distinct(), "shared")
    wanted = store(shared.select("node").distinct(), "wanted")
    nodes = signed.where("classes is not null").join(wanted, "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("classes").alias("classes"))
    nodes = nodes.select("node", "n", F.explode("classes").alias("c")).select("node", "n", "c.*")
    index = store(_index(shared, nodes, percent), "index")
    discard(signed, shared, wanted)
    found = store(index.select("node").distinct(), "found")
    keys = store(members.join(found, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key")).select("key"), "keys")
    tokens = store(_tokens(semi_join(docs, keys, "key"), n, percent), "tokens")
    comps = store(found.select("node", F.col("node").alias("comp")), "comps")
    discard(found, keys)
    # members of a group come in a fixed order by hash; those before ``low`` have been pivots
    place = F.pmod(F.xxhash64("node"), F.lit(1 << 40)) * F.col("size") / F.lit(float(1 << 40))
    low, high, last = 0, 0, index
    while True:
        # a group inside one component stays there: each round reads only what the last one left
        labelled = index.join(comps, "node")
        split = labelled.groupBy("sig").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.max_by("node", F.struct("central", "node")).alias("centre"))
        active = store(labelled.join(split.where("least <> most").select("sig", "centre"), "sig").withColumn("place", place), "active")
        discard(last)
        largest = active.agg(F.max("size")).first()[0]
        if largest is None or low >= largest:
            break
        fresh = active.where(F.col("place") >= low).withColumn("pivot", F.col("place") < high if high else F.col("node") == F.col("centre"))
        pairs = store(_pairs(fresh.where("pivot"), fresh, percent), "pairs")
        if not pairs.isEmpty():
            links = linked(overlaps(pairs, tokens), percent)
            of = [comps.select(F.col("node").alias(x), F.col("comp").alias(f"comp_{x}")) for x in "px"]
            links = links.join(of[0], "p").join(of[1], "x").select(F.col("comp_p").alias("a"), F.col("comp_x").alias("b"))
            links = store(links.distinct(), "links")
            if not links.isEmpty():
                to = components(links).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
                merged = store(comps.join(to, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "comps")
                discard(comps)
                comps = merged
            discard(links)
        discard(pairs)
        index, last = active.select(*INDEX), active
        low, high = high, (high + 1) * GROWTH
    component = F.coalesce("comp", "node").alias("component")
    return store(members.join(comps, "node", "left").select("id", "key", F.col("n").alias("n_shingles"), component), "similar")


def groups(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    found = similar_sets(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), n, percent)
    least = found.where("component is not null").groupBy("component").agg(F.min("id").alias("least"))
    return found.join(least, "component", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("least", "id").alias("component_id")
    )


def first_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (doc_id, text and others) with one document of each group: the smallest doc_id, of that the smallest text hash.

    Documents without words all stay.  Texts are moved only where more rows go than may be sent to every executor.
    """
    id_, key = F.col("doc_id").cast("long"), F.xxhash64("text")
    with scratch(docs.sparkSession) as keep:
        linked_ = similar_sets(docs.select(id_.alias("id"), "text"), n, percent).where("component is not null")
        best = linked_.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("best"))
        rows = linked_.groupBy("component", "id", "key").agg(F.count("*").alias("rows")).join(best, "component")
        is_best = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("key") == F.col("best.key"))
        changed = rows.select("id", "key", (~is_best).alias("gone"), "rows").where("gone or rows > 1")
        changed = keep(store(changed.select("id", "key", "gone"), "changed"))
    again = changed.where("not gone").select("id", "key")

    def of(rows_: DataFrame, how: str) -> DataFrame:
        few = rows_.count() <= BROADCAST_ROWS
        r = F.broadcast(rows_) if few else rows_
        return docs.join(r, (key == r["key"]) & id_.eqNullSafe(r["id"]), how)

    kept = of(changed.select("id", "key"), "left_anti")
    return kept.unionByName(of(again, "left_semi").withColumn("__key", key).dropDuplicates(["doc_id", "__key"]).drop("__key"))
