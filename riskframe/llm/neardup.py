"""Near duplicates by HyperMinHash sketches, banding and exact verification.

A sketch has 128 buckets; each keeps of its smallest shingle hash the number of
leading zeros and ten mantissa bits, 16 bits in all. Empty buckets borrow from
others in an order of their own, so short texts band as well as long ones. Bands of
four registers propose pairs, a collision-corrected estimate of the similarity drops
hopeless ones, and what is left is confirmed on the full shingle sets.

Equal sets are one node from the start. Groups of one band are not paired out. Every
member is first compared with the most connected member of its groups, its hub, and
the likeliest leader; hubs that meet in a band give way to the most connected one. Of
pairs that are still in different components, those of one hub h are found by what they
differ in from h, m missing and p outside shingles, d together. With r = (1 - t) / (1 + t),
x and y are linked if they share at least (d + d' - r * (|x| + |y|)) / 2 differences, and
x and h are not linked only if d > r * (|x| + |h|). So a pair, at least one of which is not
linked with h, shares more than (m * (1 + r) + p * (1 - r)) / 2 of the differences of the
other: an outside shingle few members have, or one of the few rarest missing shingles;
the outside shingles many members have lengthen the latter. Pairs of different hubs are
looked at as they are where a band brings few of them together. A crowd, such as all texts
with one passage, is not paired out: whatever one order all shingles are put in, two sets
that similar share one of the first (1 - t) * n + 1 of each, so the rarest first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.components import components
from riskframe.llm.shingles import mixed, shingle_sets, slices
from riskframe.sources.tables import stored

BUCKETS, BAND, MANTISSA = 128, 4, 10
#: An estimate this many standard errors below the threshold is taken for a no.
SIGMAS = 6.0
#: A leader estimated less similar than this is no hub of a member.
HUB = 0.4
#: Outside shingles of over this share of a hub's unlinked members propose no pairs.
OFTEN = 0.25
#: A group of one band with more pairs of different hubs than this for each member is a crowd.
CROWD = 8
_BELOW = np.uint64((1 << 52) - 1)


def _borrow_order() -> np.ndarray:
    """For each bucket the other buckets in an order of its own."""
    keys = mixed(np.arange(BUCKETS * BUCKETS, dtype=np.uint64) + np.uint64(977)).reshape(BUCKETS, BUCKETS)
    return np.argsort(keys, axis=1, kind="stable").astype(np.int16)


def registers(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sketches (texts x BUCKETS, uint16) of sorted hash sets, and how many buckets each filled."""
    texts = len(offsets) - 1
    out = np.zeros((texts, BUCKETS), np.uint16)
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    place = owner * BUCKETS + (hashes >> np.uint64(57)).astype(np.int64)
    first = np.ones(len(place), bool)
    first[1:] = place[1:] != place[:-1]  # hashes are sorted, so a bucket's first is its smallest
    rest = (hashes[first] >> np.uint64(5)) & _BELOW
    zeros = (52 - np.frexp(rest.astype(np.float64))[1]).astype(np.uint64)
    zeros[rest == 0] = 52
    tail = ((rest << np.minimum(zeros + np.uint64(1), np.uint64(52))) & _BELOW) >> np.uint64(52 - MANTISSA)
    out.reshape(-1)[place[first]] = ((zeros << np.uint64(MANTISSA)) | tail).astype(np.uint16) + np.uint16(1)
    filled = (out > 0).sum(1)
    original, order = out.copy(), _borrow_order()
    todo = np.flatnonzero((filled > 0) & (filled < BUCKETS))
    for step in range(BUCKETS):
        if not len(todo):
            break
        lent = original[todo[:, None], order[:, step][None, :]]
        now = out[todo]
        out[todo] = np.where(now == 0, lent, now)
        todo = todo[(out[todo] == 0).any(1)]
    return out, filled


def collision_rate(n: float, m: float) -> float:
    """Chance that a register of two unrelated sets of n and m shingles is equal."""
    a, b = max(n / BUCKETS, 1e-9), max(m / BUCKETS, 1e-9)
    same = 0.0
    for z in range(40):
        top, low = 2.0 ** -z, 2.0 ** -(z + 1)
        same += ((math.exp(-a * low) - math.exp(-a * top)) / max(1e-12, 1 - math.exp(-a))
                 * (math.exp(-b * low) - math.exp(-b * top)) / max(1e-12, 1 - math.exp(-b)))
    return same * 2.0 ** -MANTISSA


def estimate(equal: float, n: int, m: int) -> float:
    """Similarity from the number of equal registers, less those equal by chance."""
    chance = collision_rate(n, m)
    return max(0.0, (equal / BUCKETS - chance) / (1 - chance))


def sketches(df: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(key, n_shingles, set_a, set_b, filled, bands): bands hold BAND registers each in a long."""
    own = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                hashes, offsets = shingle_sets(batch.column(1), shingle)
                sums = np.zeros((2, len(offsets) - 1), np.uint64)
                for i, salt in enumerate((0x1234567, 0x7654321)):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes ^ np.uint64(salt)))])
                    sums[i] = total[offsets[1:]] - total[offsets[:-1]]
                regs, filled = registers(hashes, offsets)
                bands = regs.view("<i8")
                yield pa.record_batch([
                    batch.column(0), pa.array(np.diff(offsets), pa.int64()),
                    pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                    pa.array(filled, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1) * bands.shape[1], pa.int32()),
                                             pa.array(bands.reshape(-1)))],
                    names=["key", "n_shingles", "set_a", "set_b", "filled", "bands"])

    return own.mapInArrow(sketch, f"key {df.schema[key].dataType.simpleString()}, n_shingles bigint, "
                          "set_a bigint, set_b bigint, filled int, bands array<bigint>")


def _estimated(pairs: DataFrame, sketched: DataFrame, threshold: float, least: float = 1.0) -> DataFrame:
    """(a, b, near, hope) for the pairs whose sizes allow the threshold and whose estimates
    do, too (``hope``), or reach ``least``."""
    side = lambda s: sketched.select(F.col("key").alias(s), *(F.col(c).alias(f"{c}_{s}")
                                                              for c in ("n_shingles", "filled", "bands")))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("n_shingles_a", "n_shingles_b") >= F.lit(threshold - 1e-9) * F.greatest("n_shingles_a", "n_shingles_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.ascontiguousarray(b.column(i).flatten().to_numpy(zero_copy_only=False)).view("<u2")
                    .reshape(-1, BUCKETS) for i in (2, 3))
            equal = (x == y).sum(1)
            n, m = b.column(4).to_pylist(), b.column(5).to_pylist()
            near = np.array([estimate(e, i, j) for e, i, j in zip(equal, n, m)])
            filled = np.minimum(b.column(6).to_numpy(), b.column(7).to_numpy())
            error = np.sqrt(threshold * (1 - threshold) / np.maximum(filled, 1))
            hope = near >= threshold - SIGMAS * error
            keep = hope | (near >= least)
            yield pa.record_batch([b.column(0).filter(pa.array(keep)), b.column(1).filter(pa.array(keep)),
                                   pa.array(near[keep]), pa.array(hope[keep])], names=["a", "b", "near", "hope"])

    kind = sketched.schema["key"].dataType.simpleString()
    return both.select("a", "b", "bands_a", "bands_b", "n_shingles_a", "n_shingles_b", "filled_a", "filled_b") \
        .mapInArrow(compare, f"a {kind}, b {kind}, near double, hope boolean")


def _confirmed(pairs: DataFrame, texts: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """(a, b, linked, n, outside, missing) of the pairs: whether their full shingle sets are
    similar enough, the number of shingles of a, those b has not, and those of b that a has not."""
    both = (pairs.select("a", "b").join(texts.select(F.col("key").alias("a"), F.col("text").alias("x")), "a")
            .join(texts.select(F.col("key").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y"))
    hundred = round(threshold * 100)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, 2):
                for batch in slices(part, 3):
                    n = batch.num_rows
                    x, at_x = shingle_sets(batch.column(2), shingle)
                    y, at_y = shingle_sets(batch.column(3), shingle)
                    rows = np.concatenate([np.repeat(np.arange(n), np.diff(at_x)), np.repeat(np.arange(n), np.diff(at_y))])
                    values = np.concatenate([x, y])
                    from_x = np.arange(len(values)) < len(x)
                    order = np.lexsort((~from_x, values, rows))
                    rows, values, from_x = rows[order], values[order], from_x[order]
                    twice = (rows[1:] == rows[:-1]) & (values[1:] == values[:-1])
                    common = np.bincount(rows[1:][twice], minlength=n)
                    outside = from_x.copy()
                    outside[:-1] &= ~twice
                    union = np.diff(at_x) + np.diff(at_y) - common
                    missing = ~from_x
                    missing[1:] &= ~twice
                    yield pa.record_batch([
                        batch.column(0), batch.column(1), pa.array((100 * common >= hundred * union) & (union > 0)),
                        pa.array(np.diff(at_x), pa.int64()), *(pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows[some], minlength=n))]), pa.int32()),
                            pa.array(values[some].view(np.int64))) for some in (outside, missing))],
                        names=["a", "b", "linked", "n", "outside", "missing"])

    kind = texts.schema["key"].dataType.simpleString()
    return both.mapInArrow(check, f"a {kind}, b {kind}, linked boolean, n bigint, outside array<bigint>, missing array<bigint>")


def _of_one_hub(members: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of ``members`` (key, hub, component, linked, n, outside, missing) with the
    same hub and different components that could be similar enough; see above."""
    ratio = (1 - threshold) / (1 + threshold)
    sized = stored(members.withColumns({"p": F.size("outside"), "m": F.size("missing")}), "members")
    many = sized.where("not linked").groupBy("hub").agg((F.count("*") * OFTEN).alias("many"))
    common = (sized.where("not linked").select("hub", F.explode("outside").alias("one"))
              .groupBy("hub", "one").agg(F.count("*").alias("times")).join(many, "hub").where("times > many")
              .groupBy("hub").agg(F.collect_list("one").alias("common")))  # at most p / OFTEN on average
    sized = (sized.join(common, "hub", "left").withColumn("common", F.coalesce("common", F.expr("array()").cast("array<bigint>")))
             .withColumns({"c": F.size(F.array_intersect("outside", "common")),
                           "every": F.col("outside"), "outside": F.array_except("outside", "common")}).drop("common"))
    sized = stored(sized, "sized")  # read seven times below
    named = ("key", "component", "linked", "n", "p", "m", "c")

    def postings(df: DataFrame, of: str, side: str) -> DataFrame:
        return df.select("hub", F.explode(of).alias("one"), *(F.col(c).alias(f"{c}_{side}") for c in named))

    least = (F.col("m_a") + F.col("p_a") + F.col("m_b") + F.col("p_b")
             - F.lit(ratio) * (F.col("n_a") + F.col("n_b"))) / 2 - F.lit(1e-6)
    apart = (F.col("component_a") != F.col("component_b")) & (F.col("linked_b") | (F.col("key_a") < F.col("key_b")))
    # a is not linked with the hub; were both linked, they would be in one component
    loose = sized.where("not linked")
    missing = F.least("m_a", "m_b")
    need = F.ceil((F.col("m_b") * F.lit(1 + ratio) + F.col("p_b") * F.lit(1 - ratio)) / 2
                  - F.lit(1e-6)) - F.col("c_b")  # of the missing shingles
    # a member so near the hub that common outside shingles may be all it shares looks at those, too
    near = postings(loose, "every", "a").join(postings(sized, "every", "b").where(need < 1), ["hub", "one"])
    sharing = postings(loose, "outside", "a").join(postings(sized, "outside", "b"), ["hub", "one"]).where(
        apart).unionByName(near.where(F.col("component_a") != F.col("component_b"))).where(
        (missing + F.least("p_a", "p_b") >= least)).select("key_a", "key_b")
    lost = postings(loose, "missing", "a")
    often = stored(lost.groupBy("hub", "one").agg(F.count("*").alias("often")), "often")
    rarest = Window.partitionBy("key_b").orderBy(F.coalesce("often", F.lit(0)), "one")
    prefix = (postings(sized, "missing", "b").where(need.between(1, F.col("m_b"))).join(often, ["hub", "one"], "left")
              .withColumn("_nth", F.row_number().over(rarest)).where(F.col("_nth") <= F.col("m_b") - need + 1))
    either = F.col("component_a") != F.col("component_b")  # the prefixes of a and b differ, so both orders
    prefix = stored(prefix, "prefix")
    alike = lost.join(prefix, ["hub", "one"]).where(either & (missing + F.least("c_a", "c_b") >= least)).select("key_a", "key_b")
    return sharing.unionByName(alike).select(F.least("key_a", "key_b").alias("a"),
                                             F.greatest("key_a", "key_b").alias("b")).distinct()


def _of_crowds(members: DataFrame, texts: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """Pairs (a, b) of ``members`` (key, hub, component) with different hubs and components
    that could be similar enough: they share one of the rarest shingles of each."""
    own = members.select("key").join(texts.select(F.col("key").alias("_k"), "text"), F.col("key") == F.col("_k")).select("key", "text")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                hashes, offsets = shingle_sets(batch.column(1), shingle)
                total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes))])
                yield pa.record_batch([
                    batch.column(0), pa.array((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes.view(np.int64)))],
                    names=["key", "mark", "shingles"])

    kind = texts.schema["key"].dataType.simpleString()
    sets = own.mapInArrow(spell, f"key {kind}, mark bigint, shingles array<bigint>").groupBy("key", "mark").agg(
        F.first("shingles").alias("shingles"))  # a key may have more than one text
    spelt = stored(sets.select("key", "mark", F.size("shingles").alias("n"), F.explode("shingles").alias("one")), "spelt")
    times = spelt.groupBy("one").agg(F.count("*").alias("times")).where("times > 1")
    each = Window.partitionBy("key", "mark")
    # shingles of one text only come first and are left out
    first = spelt.join(times, "one").withColumn(
        "nth", F.col("n") - F.count("*").over(each) + F.row_number().over(each.orderBy("times", "one"))).where(
        F.col("nth") <= F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - F.lit(1e-6)) + 1)
    first = stored(first.select("key", "n", "one", "nth").join(members, "key"), "first")
    left, right = (first.select("one", *(F.col(c).alias(f"{c}_{k}") for c in ("n", "nth", "hub", "component")),
                                F.col("key").alias(k)) for k in "ab")
    # what both have from the first shared one on
    rest = F.least(F.col("n_a") - F.col("nth_a"), F.col("n_b") - F.col("nth_b")) + 1
    return left.join(right, "one").where("component_a < component_b and hub_a <> hub_b").where(
        rest >= F.lit(threshold / (1 + threshold)) * (F.col("n_a") + F.col("n_b")) - F.lit(1e-6)).select("a", "b").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
                    threshold: float = 0.8) -> DataFrame:
    """(key, n_shingles, component, kept) of every row.

    Rows are linked whose shingle sets have a Jaccard similarity of ``threshold``
    (whole hundredths) or more; the component is the smallest key reachable and
    ``kept`` says whether that is the row's own. Rows without words are linked with
    nothing. Rows with the same key are one document. A null key is linked with
    nothing, has a null component and is kept. Extra columns are not read.
    """
    sketched = stored(sketches(df, key, text, shingle), "sketches")
    usable = sketched.where("n_shingles > 0 and key is not null")
    sets = usable.groupBy("set_a", "set_b").agg(F.min("key").alias("key"), F.first("n_shingles").alias("n_shingles"),
                                                F.first("filled").alias("filled"), F.first("bands").alias("bands"))
    nodes = stored(sets, "nodes")
    rows = nodes.select("key", F.posexplode("bands").alias("band", "value"))
    crowded = stored(rows.groupBy("band", "value").agg(F.count("*").alias("size")).where("size > 1"), "crowded")
    shared = stored(rows.join(crowded, ["band", "value"]), "shared")
    # the member that shares most bands with others leads its groups
    degree = stored(shared.groupBy("key").agg(F.sum("size").alias("degree")), "degree")
    leads = (shared.join(degree, "key").groupBy("band", "value")
             .agg(F.max_by(F.col("key"), F.struct("degree", "key")).alias("lead")))
    stars = (shared.join(leads, ["band", "value"]).where("key <> lead")
             .select(F.col("key").alias("a"), F.col("lead").alias("b")).distinct())
    scored = stored(_estimated(stars, nodes, threshold, HUB), "scored")
    best = scored.where("hope").groupBy("a").agg(F.max_by("b", F.struct("near", "b")).alias("b"))
    hubs = (scored.join(degree.select(F.col("key").alias("b"), "degree"), "b")
            .groupBy("a").agg(F.max_by("b", F.struct("degree", "b")).alias("b")))
    wanted = degree.select(F.col("key").alias("_k"))
    texts = stored(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
                   .join(wanted, F.col("key") == F.col("_k"), "left_semi"), "texts")
    told = stored(_confirmed(hubs, texts, threshold, shingle), "hubs")
    others = stored(_confirmed(best.join(hubs, ["a", "b"], "left_anti"), texts, threshold, shingle)
                    .where("linked").select("a", "b"), "stars")
    links = told.where("linked").select("a", "b").unionByName(others)
    first = components(links)
    # what the stars left in different components, though in one band
    placed = stored(shared.join(first, shared["key"] == first["node"], "left").select(
        "band", "value", "key", F.coalesce("component", "key").alias("component")), "placed")
    open_ones = placed.groupBy("band", "value").agg(F.min("component").alias("low"), F.max("component").alias("high")) \
        .where("low <> high").select("band", "value")
    placed = stored(placed.join(open_ones, ["band", "value"]), "unsettled")
    # hubs that meet in a band give way to the most connected one, so a family has one hub
    hubbed = stored(placed.join(told.select(F.col("a").alias("key"), F.col("b").alias("hub")), "key").select(
        "band", "value", "hub").distinct().join(
        degree.select(F.col("key").alias("hub"), "degree"), "hub"), "hubbed")
    top = hubbed.groupBy("band", "value").agg(F.max_by("hub", F.struct("degree", "hub")).alias("b"))
    met = hubbed.join(top, ["band", "value"]).where("hub <> b").select(F.col("hub").alias("a"), "b").distinct()
    up = stored(_estimated(met, nodes, threshold, HUB).join(degree.select(F.col("key").alias("b"), "degree"), "b")
                .groupBy("a").agg(F.max_by("b", F.struct("degree", "b")).alias("_next")), "up")
    tops = told.select("a", F.col("b").alias("top")).unionByName(
        up.join(told, "a", "left_anti").select("a", F.col("a").alias("top")))
    for _ in range(3):
        tops = tops.join(up.withColumnRenamed("a", "top"), "top", "left").select(
            "a", F.coalesce("_next", "top").alias("top"))
    tops = stored(tops, "tops")
    moved = (tops.join(told.select("a", "b"), "a", "left").where("top <> a and (b is null or top <> b)")
             .join(placed.select(F.col("key").alias("a")).distinct(), "a", "left_semi")
             .select("a", F.col("top").alias("b")))
    moved = stored(_confirmed(moved, texts, threshold, shingle), "moved")
    told = told.join(moved.select("a"), "a", "left_anti").unionByName(moved)
    placed = placed.join(told.select(F.col("a").alias("key"), F.col("b").alias("_hub")), "key", "left")
    placed = stored(placed.select("band", "value", "key", "component", F.coalesce("_hub", "key").alias("hub")), "open")
    sizes = placed.groupBy("band", "value", "hub").agg(F.count("*").alias("n")).groupBy("band", "value").agg(
        F.sum("n").alias("size"), ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"))
    sizes = stored(sizes.where("pairs > 0"), "sizes")
    crowd = F.col("pairs") > F.lit(CROWD) * F.col("size")
    few = placed.join(sizes.where(~crowd).select("band", "value"), ["band", "value"])
    left, right = (few.select("band", "value", *(F.col(c).alias(f"{c}_{k}") for c in ("component", "hub")),
                              F.col("key").alias(k)) for k in "ab")
    apart = left.join(right, ["band", "value"]).where(
        "component_a < component_b and hub_a <> hub_b").select("a", "b")
    many = placed.join(sizes.where(crowd).select("band", "value"), ["band", "value"]).select(
        "key", "hub", "component").distinct()
    apart = apart.unionByName(_of_crowds(stored(many, "crowds"), texts, threshold, shingle))
    members = placed.select("key", "component").distinct().join(
        told.select(F.col("a").alias("key"), F.col("b").alias("hub"), "linked", "n", "outside", "missing"), "key")
    pairs = stored(apart.unionByName(_of_one_hub(members, threshold)).distinct(), "proposed")
    hopeful = _estimated(pairs, nodes, threshold).where("hope")
    more = stored(_confirmed(hopeful, texts, threshold, shingle).where("linked").select("a", "b"), "pairs")
    # only components are still to be joined, few against the links there are
    late = more.unionByName(moved.where("linked").select("a", "b"))
    for end in "ab":
        late = late.join(first.select(F.col("node").alias(end), F.col("component").alias("_to")), end, "left").withColumn(
            end, F.coalesce("_to", end)).drop("_to")
    second = components(late.select("a", "b")).select(F.col("node").alias("component"), F.col("component").alias("_last"))
    named = nodes.select("set_a", "set_b", F.col("key").alias("_node")).join(
        first, F.col("_node") == F.col("node"), "left").withColumn("component", F.coalesce("component", "_node")).join(
        second, "component", "left").select("set_a", "set_b", F.coalesce("_last", "component").alias("_component"))
    row = sketched.join(named.withColumn("_some", F.lit(True)), ["set_a", "set_b"], "left")
    component = F.when(F.col("key").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("key")))
    return row.select(F.col("key").alias(key), "n_shingles", component.alias("component"),
                       F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
             threshold: float = 0.8) -> DataFrame:
    """The rows of ``df`` that near_duplicates keeps, unchanged, with all their columns."""
    gone = near_duplicates(df, key, text, shingle, threshold).where("not kept").select(
        F.col(key).alias("_gone")).distinct()
    return df.join(gone, F.col(f"`{key}`") == F.col("_gone"), "left_anti")
