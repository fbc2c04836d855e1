"""Near duplicates by SimHash, searched by meeting in the middle.

Two fingerprints that differ in at most ``radius`` bits have a common variant within half the radius of both.
So every different fingerprint sends all variants in that ball, and what meets at a variant is linked. At
most as many fingerprints as the ball has members can meet (65 for radius 2), whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.llm.common import keep_rows, row_hash, saved
from loomtext.llm.components import components
from loomtext.operators.order import with_position

BITS = 64
SEED = 42
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 16


def simhash(text: Column, words: int = 3) -> Column:
    """64-bit SimHash (as a signed long) over all shingles of ``words`` words, repeats included.

    A bit is 1 if it is set in over half of the shingles' XXH64. A text with fewer words is one shingle; without words, zero.
    """

    def bits(data: bytes) -> int:
        parts = data.lower().split()  # of bytes: lower-cases A-Z only, splits at ASCII white space only
        if not parts:
            return 0
        if len(parts) <= words:
            shingles = iter([b" ".join(parts)])
            n = 1
        else:
            shingles = map(b" ".join, zip(*[parts[i:] for i in range(words)], strict=False))
            n = len(parts) - words + 1
        digest, seed = xxhash.xxh64_intdigest, SEED
        ones = np.zeros(BITS, dtype=np.int64)
        for start in range(0, n, CHUNK):
            many = min(CHUNK, n - start)
            hashes = np.fromiter((digest(next(shingles), seed) for _ in range(many)), dtype="<u8", count=many)
            spread = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += spread.sum(axis=0, dtype=np.int64)
        packed = np.packbits(ones * 2 > n, bitorder="little")
        return int(packed.view("<i8")[0])

    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([bits(t.encode()) if t else 0 for t in texts], dtype="int64")

    return of(text)


def variants(fingerprint: str, distance: int) -> Column:
    """All numbers that differ from the column in at most ``distance`` bits."""
    masks = [sum(1 << b for b in chosen) for k in range(distance + 1) for chosen in combinations(range(BITS), k)]
    signed = ",".join(str(m - (1 << BITS) if m >> (BITS - 1) else m) for m in masks)
    return F.expr(f"transform(cast(split('{signed}', ',') as array<bigint>), m -> `{fingerprint}` ^ m)")


def near_links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) that connect all ``fp`` at most ``radius`` (an even number) bits apart.

    All that meet at a variant lie within ``radius`` of each other, so a chain through them says the same as all
    pairs, and the longest chain has one link less than the ball has members. Every link is verified.
    """
    if radius % 2 or radius < 0:
        raise ValueError("the radius must be even: both sides go half the way")
    met = prints.select("fp", F.explode(variants("fp", radius // 2)).alias("variant"))
    before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    pairs = met.select(before.alias("a"), F.col("fp").alias("b")).where("a IS NOT NULL")
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, root) for the different fingerprints that have a link."""
    return components(near_links(prints.select("fp").distinct(), radius)).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents are linked if their fingerprints differ in at most ``radius`` bits; component_id is the smallest doc_id
    that links reach, a null doc_id counting as none (null if the component has only such). Null and empty texts have fingerprint zero. Repeated rows stay. An empty
    table gives an empty result; other columns are left out.
    """
    prints = saved(docs.select("doc_id", simhash(F.col("text"), words).alias("fp")), "fingerprints")
    return prints.join(_named(prints, radius), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _named(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id) for all fingerprints."""
    least = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    rooted = least.join(_classes(least, radius), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return saved(rooted.select("fp", "root").join(ids, "root").select("fp", "component_id"), "components")


# --- near copies by similarity: sets of five-word shingles that have at least 0.8 in common
#
# At that similarity fingerprints differ in far more than two of 64 bits. So a text gets a wide fingerprint of two-word shingles that is cut into
# bands of 32 bits; in one of the bands near copies are as good as sure to lie within two bits (measured: 99 % at six bands for similarities of 0.8 to
# 0.85, all above), and every band is searched by meeting in the middle as above. A second wide fingerprint, of the five-word shingles, rules out most of
# what meets by chance; the sets of hashed shingles of the others are compared themselves.

#: Bands of 32 bits, bits searched in each, 64-bit lanes of the verifying fingerprint.
BANDS, BAND_RADIUS, LANES = 6, 2, 16
#: How far below the similarity asked for an estimate may lie before the sets themselves are compared (four of its standard errors at 1,024 bits), and
#: sets so small that they are compared whatever the estimate.
MARGIN, SMALL = 0.12, 64
#: Nodes of a part of a band's value. Nodes around a band's that its nodes are compared with one by one; more are a crowd.
PART, CROWD = 1024, 32

SKETCH = "bands array<bigint>, wide array<bigint>, size int, whole bigint"


def _mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64 (Steele, Lea and Flood 2014)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _shingles(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words from the hashes of the words; fewer words are one run."""
    length = min(length, len(words))
    total = np.zeros(len(words) - length + 1, dtype=np.uint64)
    for i in range(length):
        total = _mixed(total ^ words[i : len(words) - length + 1 + i]) + np.uint64(i)
    return total


def _hashed_words(data: bytes) -> np.ndarray:
    """Hashes of the words, lower-cased and split as in ``simhash``."""
    parts, digest = data.lower().split(), xxhash.xxh64_intdigest
    return np.fromiter((digest(p, SEED) for p in parts), dtype=np.uint64, count=len(parts))


def _majority(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """``lanes`` 64-bit words of a SimHash: a bit is set if over half of the hashes' derived bits are."""
    salts = _mixed(np.arange(1, lanes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ones = np.zeros(64 * lanes, dtype=np.int64)
    for at in range(0, len(hashes), 4080):
        derived = _mixed(hashes[at : at + 4080, None] ^ salts)
        spread = np.unpackbits(derived.view(np.uint8), axis=1, bitorder="little")
        for block in range(0, len(spread), 255):  # as many as a byte can count
            ones += spread[block : block + 255].sum(axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")


def sketch(text: Column, words: int = 5) -> Column:
    """Bands, wide fingerprint, number of different shingles of a text and a hash of all of them; words as in ``simhash``."""

    def of_bytes(data: bytes) -> tuple[list[int], list[int], int, int]:
        hashed = _hashed_words(data)
        if not len(hashed):
            return [], [0] * LANES, 0, 0
        narrow = _majority(_shingles(hashed, 2), -(-BANDS // 2)).view("<u4")[:BANDS]
        runs = np.unique(_shingles(hashed, words))
        whole = np.uint64(xxhash.xxh64_intdigest(runs.tobytes(), SEED)).astype(np.int64)
        return [(i << 32) + int(v) for i, v in enumerate(narrow)], _majority(runs, LANES).view("<i8").tolist(), len(runs), int(whole)

    @F.pandas_udf(SKETCH)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [of_bytes(t.encode() if t else b"") for t in texts]
            yield pd.DataFrame(rows, columns=["bands", "wide", "size", "whole"])

    return of(text)


def shingle_set(text: Column | str, words: int = 5) -> Column:
    """Hashes of the different shingles of a text, the ones ``sketch`` counts."""

    @F.pandas_udf("array<bigint>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            hashed = (_hashed_words(t.encode() if t else b"") for t in texts)
            yield pd.Series([np.unique(_shingles(h, words)).view(np.int64) if len(h) else np.zeros(0, np.int64) for h in hashed], dtype=object)

    return of(text)


def similarity_of(one: str, other: str) -> Column:
    """Estimated Jaccard similarity of two columns with sketches: the angle between fingerprints gives the cosine of the sets."""
    apart = F.aggregate(
        F.zip_with(f"{one}.wide", f"{other}.wide", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n
    )
    a, b = F.col(f"{one}.size").cast("double"), F.col(f"{other}.size").cast("double")
    common = F.greatest(F.cos(F.lit(np.pi / (64 * LANES)) * apart), F.lit(0.0)) * F.sqrt(a * b)
    return F.when(a + b == 0, F.lit(1.0)).otherwise(common / (a + b - common))


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles have at least that Jaccard similarity, counted exactly.

    Sizes too different rule a pair out exactly, a far lower estimate all but surely; the sets of what is left are made from the texts and compared.
    """
    one = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("one"))
    two = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("two"))
    a, b = F.col("one.size"), F.col("two.size")
    likely = (F.least(a, b) <= SMALL) | (similarity_of("one", "two") >= similarity - MARGIN)
    likely = likely & (F.least(a, b) >= similarity * F.greatest(a, b) - 1e-6)
    close = saved(pairs.join(one, "a").join(two, "b").where(likely).select("a", "b"), "close")
    wanted = close.select(F.col("a").alias("node")).union(close.select("b")).distinct()
    sets = saved(texts.join(wanted, "node", "left_semi").select("node", shingle_set("text", words).alias("set")), "sets")
    x = sets.select(F.col("node").alias("a"), F.col("set").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    exact = both / (F.size("x") + F.size("y") - both)
    return saved(close.join(x, "a").join(y, "b").where(exact >= similarity).select("a", "b"), "verified")


def similar_links(nodes: DataFrame, texts: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """Links (a, b) that connect all ``nodes`` (node, sketch) that meet in a band and have at least that similarity, counted on ``texts`` (node, text).

    First every node is compared with the first node of its own value of each band and with the smallest of those of the values within ``BAND_RADIUS`` bits.
    What is connected then needs no more links; of all others that meet every pair is compared, where these are few for the nodes they join. Crowds
    (families of texts that share much, but too little) are searched by what tells their members from the family instead.
    """
    at = nodes.select("node", F.explode("sketch.bands").alias("band"))
    first = saved(at.groupBy("band").agg(F.min("node").alias("first")), "bands")
    near = saved(_near_values(first.select("band")), "near")
    known = first.withColumnsRenamed({"band": "hi", "first": "other"})
    beside = near.union(near.select("hi", "lo")).join(known, "hi").groupBy(F.col("lo").alias("band")).agg(F.min("other").alias("other"))
    met = at.join(first.join(beside, "band", "left"), "band").select("node", F.explode(F.array("first", "other")).alias("other"))
    links = _verified(_ordered(met.where("other IS NOT NULL AND node != other"), "node", "other"), nodes, texts, words, similarity)
    groups = components(links)
    crowds = _crowds(at, near, groups)
    if not crowds.isEmpty():
        links = links.union(_crowd_links(crowds, at, groups, nodes, texts, words, similarity))
        groups = components(links)
    rest = _unconnected(at, near.join(crowds, ["lo", "hi"], "left_anti"), crowds, groups)
    return links if rest is None else links.union(_verified(rest, nodes, texts, words, similarity))


def _members(at: DataFrame, groups: DataFrame) -> DataFrame:
    return at.join(groups, "node", "left").select("node", "band", F.coalesce("root", "node").alias("root"))


def _crowds(at: DataFrame, near: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs (lo, hi) of near or equal bands, one of which has so many not connected nodes around it that each of its nodes would be compared with over ``CROWD``."""
    sizes = _members(at, groups).groupBy("band", "root").agg(F.count("*").alias("n"))
    whole = saved(sizes.groupBy("band").agg(F.max(F.struct("n", "root")).alias("big"), F.sum("n").alias("total")), "totals")
    side = lambda name, i: whole.select(F.col("band").alias(name), F.col("big").alias(f"big{i}"), F.col("total").alias(f"n{i}"))
    both = near.union(whole.select("band", "band")).join(side("lo", 1), "lo").join(side("hi", 2), "hi")
    connected = F.when(F.col("big1.root") == F.col("big2.root"), F.col("big1.n") * F.col("big2.n")).otherwise(0)
    ties = saved(both.select("lo", "hi", "n1", "n2", (F.col("n1") * F.col("n2") - connected).alias("pairs")).where("pairs > 0"), "ties")
    around = ties.select(F.col("lo").alias("band"), "pairs", F.col("n1").alias("n")).union(ties.where("lo != hi").select("hi", "pairs", "n2"))
    full = around.groupBy("band").agg(F.sum("pairs").alias("pairs"), F.first("n").alias("n")).where(F.col("pairs") > CROWD * F.col("n")).select("band")
    crowded = ties.join(full, F.col("lo") == F.col("band"), "left_semi").union(ties.join(full, F.col("hi") == F.col("band"), "left_semi"))
    return saved(crowded.select("lo", "hi").distinct(), "crowds")


def _crowd_links(crowds: DataFrame, at: DataFrame, groups: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Links that connect all similar nodes of each family: the nodes of bands that ``crowds`` (lo, hi) tie together.

    A shingle that over half of a family has is noted where it is missing, any other where it is. That changes no difference of two sets, and what is noted (the
    marks) is little and mostly rare. Sets of sizes s and s' are similar if they differ in at most c (s + s') shingles, c = (1 - similarity) / (1 + similarity). So
    nodes with m and m' marks that have fewer together are similar, and linking all to the node with the least m - c s says the same;
    all others must share (m + m' - c (s + s')) / 2 marks, hence one of their rarest but that many. These prefixes are joined for each two classes of m, the largest group of
    the family on one side only, and every pair that meets is verified. Work follows the rare marks that are really shared, not the pairs of a family.
    """
    c = (1 - similarity) / (1 + similarity)
    bands = crowds.select(F.col("lo").alias("band")).union(crowds.select("hi")).distinct()
    inside = at.join(bands, "band", "left_semi")
    apart = lambda name: (-1 - F.col(name)).alias(name)  # noqa: E731  bands are negative, nodes are not
    graph = inside.select(F.col("node").alias("a"), (-1 - F.col("band")).alias("b")).union(crowds.select(apart("lo"), apart("hi")))
    family = components(graph).where("node >= 0").select("node", F.col("root").alias("family"))
    sets = saved(texts.join(family, "node").select("node", "family", shingle_set("text", words).alias("set")), "sets")
    totals = sets.groupBy("family").agg(F.count("*").alias("total"))
    shared = sets.select("family", F.explode("set").alias("mark")).groupBy("family", "mark").agg(F.count("*").alias("n")).join(totals, "family")
    common = saved(shared.where("2 * n > total").groupBy("family").agg(F.collect_list("mark").alias("common")), "common")  # at most twice the mean set
    told = sets.join(common, "family", "left").withColumn("common", F.coalesce("common", F.array().cast("array<bigint>")))
    missing = F.transform(F.array_except("common", "set"), F.bitwise_not)
    marked = saved(told.select("node", "family", F.size("set").alias("s"), F.concat(F.array_except("set", "common"), missing).alias("marks")), "marks")
    sized = marked.select("node", "family", "s", F.size("marks").alias("m"))

    weight = F.col("m") - c * F.col("s")
    centre = sized.groupBy("family").agg(F.min(F.struct(weight.alias("w"), F.col("node").alias("other"))).alias("least"))
    sure = sized.join(centre, "family").where((weight + F.col("least.w") <= 1e-6) & (F.col("node") != F.col("least.other")))
    links = _verified(_ordered(sure.select("node", F.col("least.other").alias("other")), "node", "other"), nodes, texts, words, similarity)

    root = components(links.union(groups.select("node", "root"))).withColumnsRenamed({"root": "group"})
    grouped = sized.join(root, "node", "left").withColumn("group", F.coalesce("group", "node"))
    largest = grouped.groupBy("family", "group").agg(F.count("*").alias("n")).groupBy("family").agg(F.max(F.struct("n", "group")).alias("most"))
    grouped = saved(grouped.join(largest, "family").select("node", "s", "m", "group", (F.col("group") != F.col("most.group")).alias("outside")), "groups")
    one = marked.select("node", "family", F.explode("marks").alias("mark"))
    rarity = one.groupBy("family", "mark").agg(F.count("*").alias("n")).where("n > 1")  # what one node has nothing meets, and sorts first
    ranked = one.join(rarity, ["family", "mark"], "left").groupBy("node", "family").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "mark"))).alias("marks"))
    probes = saved(_probes(ranked.join(grouped, "node"), c, similarity), "probes")
    names = {"node": "other", "s": "s2", "m": "m2", "group": "group2", "outside": "outside2", "place": "place2", "own": "partner", "partner": "own", "family": "family", "mark": "mark"}
    theirs = probes.select(*[F.col(n).alias(other) for n, other in names.items()])
    need = (F.col("m") + F.col("m2") - c * (F.col("s") + F.col("s2"))) / 2 - 1e-6
    fits = (F.col("place") <= F.col("m") - need + 1) & (F.col("place2") <= F.col("m2") - need + 1)
    once = ~F.col("outside2") | (F.col("node") < F.col("other"))
    met = probes.where("outside").join(theirs, ["family", "mark", "own", "partner"])
    met = met.where((F.col("group") != F.col("group2")) & once & fits)
    return links.union(_verified(_ordered(met, "node", "other"), nodes, texts, words, similarity))


def _probes(ranked: DataFrame, c: float, similarity: float) -> DataFrame:
    """The shared marks of each node's prefix (place from 1) for every class of partners that may be similar; ``own`` and ``partner`` are classes of m."""
    log, step = np.log(1.25), 1.25
    klass = lambda m: F.floor(F.log(m + 1.0) / log + 1e-9).cast("int")
    off = c * F.col("s") * (1 + 1 / similarity)  # a similar set has at most s / similarity shingles
    classes = F.sequence(klass(F.greatest(F.col("m") - off, F.lit(0.0))), klass(F.col("m") + off))
    least = lambda k: F.ceil(F.pow(F.lit(step), k) - 1.0 - 1e-6)  # noqa: E731  marks of the smallest node of a class
    need = lambda k: F.greatest(F.ceil((F.col("m") + least(k) - off) / 2 - 1e-6), F.lit(1))
    ends = F.transform(classes, lambda k: F.struct(k.alias("partner"), (F.col("m") - need(k) + 1).cast("int").alias("end"), need(k).alias("need"), least(k + 1).alias("beyond")))
    each = ranked.withColumn("own", klass(F.col("m"))).withColumn("to", F.explode(F.filter(ends, lambda e: (e["end"] > 0) & (e["need"] < e["beyond"]))))
    prefix = each.select("node", "family", "s", "m", "group", "outside", "own", F.col("to.partner").alias("partner"), F.posexplode(F.expr("slice(marks, 1, to.end)")).alias("place", "of"))
    return prefix.where("of.n > 1").select("node", "family", "s", "m", "group", "outside", "own", "partner", (F.col("place") + 1).alias("place"), F.col("of.mark").alias("mark"))


def _ordered(pairs: DataFrame, one: str, other: str) -> DataFrame:
    return saved(pairs.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct(), "pairs")


def _near_values(values: DataFrame) -> DataFrame:
    """Pairs (lo, hi) of the different ``band`` within ``BAND_RADIUS`` bits; at a variant meet at most as many as the ball has members."""
    if BAND_RADIUS != 2:
        raise ValueError("both sides go half the way: one bit of the band")
    listed = ",".join(map(str, [0, *(1 << b for b in range(32))]))
    met = values.select("band", F.explode(F.expr(f"transform(cast(split('{listed}', ',') as array<bigint>), m -> band ^ m)")).alias("variant"))
    before = Window.partitionBy("variant").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    earlier = met.select(F.collect_list("band").over(before).alias("earlier"), F.col("band").alias("hi"))
    return earlier.select(F.explode("earlier").alias("lo"), "hi").distinct()


def _unconnected(at: DataFrame, near: DataFrame, crowds: DataFrame, groups: DataFrame) -> DataFrame | None:
    """Pairs (a, b) of the nodes ``at`` (node, band) one band or two ``near`` ones that are in different ``groups`` (node, root), the ``crowds`` (lo, hi) left out.

    A band's nodes are dealt to parts, a large group of connected ones to parts of its own, and pairs of parts that hold
    one group are left out, so no task gets more than some parts and a group is not paired with itself.
    """
    member = _members(at, groups)
    sizes = saved(member.groupBy("band", "root").agg(F.count("*").alias("n")), "members")
    whole = sizes.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.sum("n").alias("total"))
    one = whole.select(F.col("band").alias("lo"), F.col("least").alias("l1"), F.col("most").alias("m1"))
    two = whole.select(F.col("band").alias("hi"), F.col("least").alias("l2"), F.col("most").alias("m2"))
    mixed = whole.where("least < most").select(F.col("band").alias("lo"), F.col("band").alias("hi"))
    several = "least(l1, l2) < greatest(m1, m2)"
    ties = saved(near.join(one, "lo").join(two, "hi").where(several).select("lo", "hi").union(mixed.join(crowds, ["lo", "hi"], "left_anti")), "ties")
    if ties.isEmpty():
        return None
    asked = ties.select(F.col("lo").alias("band")).union(ties.select("hi")).distinct()
    deal = lambda column, n: F.pmod(F.xxhash64(column), F.ceil(n / F.lit(PART)))
    part = F.when(F.col("n") > PART, F.xxhash64("root", deal("node", F.col("n")))).otherwise(deal("root", F.col("total")))
    dealt = member.join(asked, "band", "left_semi").join(sizes, ["band", "root"]).join(whole.select("band", "total"), "band")
    placed = saved(dealt.select("band", part.alias("part"), "root", "node"), "parts")
    parts = placed.groupBy("band", "part").agg(F.min("root").alias("l"), F.max("root").alias("m"))
    as_of = lambda df, b, i: df.withColumnsRenamed({"band": b, **{c: f"{c}{i}" for c in ("part", "root", "node", "l", "m")}})
    work = ties.join(as_of(parts, "lo", 1), "lo").join(as_of(parts, "hi", 2), "hi")
    work = saved(work.where(f"(lo != hi OR part1 <= part2) AND {several}").select("lo", "part1", "hi", "part2"), "work")
    pairs = work.join(as_of(placed, "lo", 1), ["lo", "part1"]).join(as_of(placed, "hi", 2), ["hi", "part2"])
    return _ordered(pairs.where("root1 != root2"), "node1", "node2")


def drop_near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of each group of near copies, with all columns: the one with the smallest doc_id (then the largest row hash).

    Near copies are texts whose sets of ``words``-word shingles have a Jaccard similarity of ``similarity`` or more; groups are what links connect. Texts without a word (null
    and empty ones too) are one group, rows alike in every column are one row, and a null doc_id comes after all others.
    """
    prints = docs.select("doc_id", row_hash(docs).alias("hash"), sketch(F.col("text"), words).alias("sketch"))
    rows = saved(prints.groupBy("doc_id", "hash", "sketch").agg(F.count("*").alias("copies")), "sketches")
    order = lambda r: F.struct(r["doc_id"].isNull(), r["doc_id"], -r["hash"].cast("decimal(20,0)"))
    row = F.struct("doc_id", "hash", "copies")
    different = rows.groupBy("sketch").agg(F.min_by(row, order(row)).alias("best")).withColumn("mark", F.xxhash64("sketch"))
    nodes = saved(with_position(different, ["mark", "sketch"], F.shiftright("mark", 52), "node").drop("mark"), "nodes")
    keyed = nodes.select("node", F.col("best.doc_id").alias("__id"), F.col("best.hash").alias("__hash"))
    hashed = docs.select("doc_id", "text", row_hash(docs).alias("hash"))
    same = hashed["doc_id"].eqNullSafe(keyed["__id"]) & (hashed["hash"] == keyed["__hash"])
    links = lambda wanted: similar_links(nodes.select("node", "sketch"), wanted, words, similarity)
    groups = components(links(hashed.join(keyed, same).select("node", "text")))
    rooted = nodes.select("node", "best").join(groups, "node", "left").select(F.coalesce("root", "node").alias("root"), "best")
    best = rooted.groupBy("root").agg(F.min_by("best", order(F.col("best"))).alias("best"))
    return keep_rows(docs, saved(best.select("best.*"), "winners"))
