"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: 64-bit majority votes over the XXH64 hashes of word shingles.
Search: the bits fall into m partitions; with thresholds t_1..t_m summing to
bound - m + 1, two fingerprints within the bound agree up to t_i bits on some
partition i.  Correlated bits share a partition, which leaves the other
partitions more selective; the thresholds are unequal and chosen by dynamic
programming on candidate counts estimated from all fingerprints.  A partition
with threshold t is probed by equal values after masking each choice of t of
its bits.  Candidates are verified by their bit distance.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import (VECTOR_FIELDS, if_small, map_slices, stage, table, texts_of,
                                  vector_rows, vector_sum)
from linepulse.llm.components import components

BITS = 64
SEED = 42
SHINGLE_BLOCK = 1 << 16      # hashes whose bits are counted at once
PAIR_GROUP = 16              # larger groups of equal probes go through midpoints
PROBE_COST, VERIFY_COST = 1.0, 1.0


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of a whole text; no words give zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    digest, total = xxhash.xxh64_intdigest, len(words) - width + 1
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, total, SHINGLE_BLOCK):
        hi = min(total, lo + SHINGLE_BLOCK)
        columns = [words[lo + k:hi + k] for k in range(width)]
        hashes = np.fromiter((digest(s, SEED) for s in map(b" ".join, zip(*columns))),
                             dtype="<u8", count=hi - lo)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits((ones * 2 > total).astype(np.uint8), bitorder="little")
    return int(packed.view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3,
                     name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit long."""
    def make():
        def fn(part: pa.RecordBatch) -> list[pa.Array]:
            values = np.array([fingerprint(t, shingle) for t in texts_of(part, text)], dtype="<u8")
            return [pa.array(values.view("<i8"), pa.int64())]
        return fn
    return map_slices(docs, make, f"`{name}` long")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _mask(bits) -> int:
    return sum(1 << int(b) for b in bits)


def _bit_moments(classes: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of fingerprints, share of ones by bit, and bit correlations."""
    def run(batches):
        ones, n, part = np.zeros((BITS, BITS)), 0, 0
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for lo in range(0, len(fps), 4096):
                rows = np.ascontiguousarray(fps[lo:lo + 4096]).view(np.uint8).reshape(-1, 8)
                bits = np.unpackbits(rows, axis=1, bitorder="little").astype(np.float32)
                ones += bits.T @ bits
                n += len(bits)
        rows = [*vector_rows("ones", part, ones), *vector_rows("n", part, np.array([n]))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.binary())], names=["name", "part", "vec"])

    sums = vector_sum(classes.select("fp").mapInArrow(run, VECTOR_FIELDS))
    n = int(sums["n"][0]) if sums else 0
    if not n:
        return 0, np.full(BITS, 0.5), np.zeros((BITS, BITS))
    both = sums["ones"].reshape(BITS, BITS) / n
    share = np.diag(both).copy()
    sd = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    return n, share, (both - np.outer(share, share)) / np.outer(sd, sd)


def correlated_partitions(correlation: np.ndarray, m: int) -> list[list[int]]:
    """m groups of bits of about equal size; each takes in, one by one, the
    free bit with the strongest correlation to the bits it already has."""
    strength, free, groups = np.abs(correlation), list(range(BITS)), []
    np.fill_diagonal(strength, 0)
    for g in range(m):
        size = (BITS - sum(map(len, groups))) // (m - g)
        first = max(free, key=lambda b: (strength[b, free].sum(), -b))
        group = [first]
        free.remove(first)
        while len(group) < size:
            best = max(free, key=lambda b: (strength[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds of least summed cost with the given total, by dynamic
    programming over the partitions; costs[i] maps a threshold to its cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (c, chosen) in best.items():
            for t, extra in cost.items():
                if spent + t not in step or c + extra < step[spent + t][0]:
                    step[spent + t] = (c + extra, [*chosen, t])
        best = step
    return best[total]


def plan_probes(classes: DataFrame, bound: int) -> list[int]:
    """The bit masks to probe, over the cheapest partitioning and allocation.

    Exact counts of equal pairs on every partition come from all fingerprints;
    pairs within t > 0 bits are estimated from them and from the shares of
    ones, as if a partition's bits differed independently.
    """
    n, share, correlation = _bit_moments(classes)
    if n < 2:
        return []
    layouts = [correlated_partitions(correlation, m) for m in range(2, bound + 3) if m <= bound + 1]
    masks = [_signed(_mask(g)) for groups in layouts for g in groups]
    values = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(v)).alias("v"))
        for k, v in enumerate(masks)]))
    equal = {r["k"]: float(r["pairs"]) for r in (
        classes.select(values.alias("s")).groupBy("s.k", "s.v")
        .agg(F.count(F.lit(1)).cast("double").alias("c")).groupBy("k")
        .agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs")).collect())}
    same = share ** 2 + (1 - share) ** 2
    found: list[tuple[float, list[int]]] = []
    at = 0
    for groups in layouts:
        costs = []
        for group in groups:
            odds = (1 - same[group]) / same[group]
            within = [1.0] + [0.0] * bound          # elementary symmetric sums of the odds
            for o in odds:
                for t in range(bound, 0, -1):
                    within[t] += within[t - 1] * o
            pairs = equal.get(at, 0.0)
            cost = {-1: 0.0}
            for t in range(bound + 1):
                probes = len(list(combinations(group, t)))
                cost[t] = PROBE_COST * n * probes + VERIFY_COST * pairs * sum(within[:t + 1])
            costs.append(cost)
            at += 1
        price, thresholds = allocate(costs, bound - len(groups) + 1)
        probes = [_mask(set(g) - set(c)) for g, t in zip(groups, thresholds) if t >= 0
                  for c in combinations(g, t)]
        found.append((price, probes))
    return min(found, key=lambda x: x[0])[1]


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def near_pairs(classes: DataFrame, bound: int = 2, probes: list[int] | None = None) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that join exactly the
    fingerprints connected by distances within ``bound`` (at most 2).

    A group of two equal probes is read off its least and greatest member, a
    small group is joined with itself, and both are verified.  In a group
    beyond PAIR_GROUP the members meet instead at midpoints: each gives itself
    and every value one flip of an unprobed bit away, and all that share one
    are linked to its least member.  Members of a group within 2 bits share
    such a midpoint and sharing one means a distance within 2, so no link is
    lost or added and the rows stay linear in the group.
    """
    if not 1 <= bound <= 2:
        raise ValueError("bound must be 1 or 2")
    probes = plan_probes(classes, bound) if probes is None else probes
    spark = classes.sparkSession
    if not probes:
        return spark.createDataFrame([], "u long, v long")
    keys = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v"))
        for k, m in enumerate(probes)]))
    signed = classes.select("fp", keys.alias("s")).select("fp", "s.k", "s.v")
    groups = stage(signed.groupBy("k", "v").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
        .filter("n > 1"), "probes")
    two = groups.filter("n = 2").select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    more = signed.join(groups.filter("n > 2").select("k", "v", "n"), ["k", "v"])
    small = more.filter(F.col("n") <= PAIR_GROUP).select("k", "v", F.col("fp").alias("a"))
    mates = small.select("k", "v", F.col("a").alias("b"))
    close = (small.join(mates, ["k", "v"]).filter("a < b")
             .select(F.col("a").alias("u"), F.col("b").alias("v")))
    checked = two.unionByName(close).filter(_distance("u", "v") <= bound)
    large = more.filter(F.col("n") > PAIR_GROUP)
    if bound == 1:
        flips = F.array(*[F.struct(F.lit(b).alias("b"), F.col("fp").bitwiseAND(
            F.lit(_signed(~(1 << b) & ((1 << BITS) - 1)))).alias("w")) for b in range(BITS)])
    else:
        flips = F.array(F.struct(F.lit(0).alias("b"), F.col("fp").alias("w")),
                        *[F.struct(F.lit(0).alias("b"), F.col("fp").bitwiseXOR(
                            F.lit(_signed(1 << b))).alias("w")) for b in range(BITS)])
    # The flipped bits may lie in the probed mask too; those values only add
    # midpoints of true pairs.  A fingerprint in several large groups counts once.
    spread = large.select("fp").distinct().select("fp", F.explode(flips).alias("s"))
    least = spread.groupBy("s.b", "s.w").agg(F.min("fp").alias("u"), F.count(F.lit(1)).alias("n"))
    star = (spread.select("fp", "s.b", "s.w").join(least.filter("n > 1"), ["b", "w"])
            .filter("fp > u").select("u", F.col("fp").alias("v")))
    return checked.unionByName(star).distinct()


def component_roots(ids: DataFrame, bound: int = 2) -> DataFrame:
    """(fp, root, component_id) of every fingerprint of ``ids`` (id, fp): the
    component's smallest fingerprint and smallest id."""
    classes = stage(ids.groupBy("fp").agg(F.min("id").alias("rep")), "classes")
    roots = stage(components(near_pairs(classes, bound)), "roots")
    linked = classes.join(roots, classes["fp"] == roots["u"], "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    smallest = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    return linked.join(smallest, "root").select("fp", "root", "component_id")


def _ids(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    body = F.col(f"`{text}`")
    return stage(with_fingerprint(docs.select(F.col(f"`{doc_id}`").alias("id"),
                                              body.alias("text"), F.xxhash64(body).alias("th")),
                                  shingle=shingle).select("id", "th", "fp"), "fingerprints")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = 3, bound: int = 2) -> DataFrame:
    """(doc_id, fp, component_id), a row per row of ``docs``: the fingerprint
    as a signed long and the smallest id that a chain of links of at most
    ``bound`` bits reaches.

    Texts of equal fingerprints form one class first, whatever their number.
    A null, empty or blank text has fingerprint zero and is linked like any
    other.  Repeated rows stay and share a component.  A null id is passed
    over by the minimum; a component of null ids only has a null one.  Other
    columns are ignored; an empty table gives an empty result.
    """
    ids = _ids(docs, doc_id, text, shingle)
    return (ids.join(component_roots(ids, bound), "fp")
            .select(F.col("id").alias("doc_id"), "fp", "component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             shingle: int = 3, bound: int = 2) -> DataFrame:
    """``docs`` with exactly one row of each component: that of the smallest
    id (null ids last; of rows sharing the id, the text of the smallest hash;
    of identical rows any one).  Columns stay as they are.

    The rows that go are joined out; only their keys are broadcast, and only
    up to BROADCAST_ROWS rows.
    """
    ids = _ids(docs, doc_id, text, shingle)
    marked = ids.join(component_roots(ids, bound).select("fp", "root"), "fp")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "th")
    keys = stage(marked.groupBy("root", "id", "th").agg(F.count(F.lit(1)).alias("copies")), "keys")
    first = keys.groupBy("root").agg(F.min(order).alias("first"))
    judged = keys.join(first, "root").withColumn("stays", order == F.col("first"))
    judged = stage(judged.select(F.col("id").alias("_id"), F.col("th").alias("_th"),
                                 "stays", "copies"), "judged")
    gone = if_small(judged.filter("not stays").select("_id", "_th"))
    many = if_small(judged.filter("stays and copies > 1").select("_id", "_th"))

    def same(keys: DataFrame):
        return (F.col(f"`{doc_id}`").eqNullSafe(keys["_id"])
                & (F.xxhash64(F.col(f"`{text}`")) == keys["_th"]))

    rest = docs.join(gone, same(gone), "left_anti")
    if judged.filter("stays and copies > 1").isEmpty():
        return rest
    repeated = rest.join(many, same(many), "left_semi").dropDuplicates([doc_id, text])
    return rest.join(many, same(many), "left_anti").unionByName(repeated)


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (contract: 3 words, 2 bits)."""
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bound=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")
