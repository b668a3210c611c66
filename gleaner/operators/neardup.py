"""Perceptual near-duplicates: pairs within a Hamming distance, and order-exact greedy marking.

Pairs. The 64 bits are cut in m = distance // 2 + 1 segments, so codes within the distance agree in one of them up to a
single bit. A code is filed under each segment's value and under those with one 0 bit set, and codes are joined by
(segment, value): an equi-join that loses nothing. Only distinct codes are joined; rows of one code are never paired.
A value that holds over CROWD codes is filed again by segments of its other bits, which must agree in the same way.

Marking. Rows are taken largest first, then by sha256; a row within the distance of an indexed one is marked with the
closest (the lowest index position among equals), else it is indexed; a row with more pixels than a stored one that is its
closest takes that one's slot. All of it is settled in rounds of joins and aggregates (_settled); no task holds a
component, however large.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.config import Dedupe
from gleaner.operators.stage import StageResult, rejection
from gleaner.plans.storage import discard, materialize, shuffled


#: Codes that share a key up to which they are compared with each other.
CROWD = 256


def _keys(code: Column, bits: list[int], distance: int) -> Column:
    """The keys of a code over the given bits (places in it): part, value and near (0 for its own value, 1 for one with a 0 bit set). Codes within the distance over these bits meet under a key that is one's own."""
    m = distance // 2 + 1
    bounds = [round(len(bits) * k / m) for k in range(m + 1)]

    def of(k: int) -> Column:
        mask = sum(1 << b for b in bits[bounds[k] : bounds[k + 1]])
        long = lambda x: F.lit(x - (1 << 64) if x >> 63 else x).cast("long")
        own = code.bitwiseAND(long(mask))
        zeros = F.filter(F.array(*[long(1 << b) for b in bits[bounds[k] : bounds[k + 1]]]), lambda bit: own.bitwiseAND(bit) == 0)
        key = lambda v, near: F.struct(F.lit(k).alias("part"), v.alias("value"), F.lit(near).alias("near"))
        return F.concat(F.array(key(own, 0)), F.transform(zeros, lambda bit: key(own.bitwiseOR(bit), 1)))

    return F.concat(*map(of, range(m)))


def segments(distance: int) -> list[list[int]]:
    """The bits of each first-level part."""
    m = distance // 2 + 1
    bounds = [round(64 * k / m) for k in range(m + 1)]
    return [list(range(bounds[k], bounds[k + 1])) for k in range(m)]


def filed(codes: DataFrame, distance: int) -> DataFrame:
    """code, part, value and near of every key of each code."""
    return codes.select("code", F.explode(_keys(F.col("code"), list(range(64)), distance)).alias("x")).select("code", "x.*")


def meeting(own: DataFrame, all_: DataFrame, distance: int, crowd: int | None = None) -> DataFrame:
    """own and all_: filed codes. a < b and d of all pairs within the distance whose keys meet, one of them its own from own.

    Keys whose codes would make over crowd * crowd pairs are met by a second key, over the bits that the first leaves open: codes within
    the distance agree there in a segment up to a bit as well, so nothing is lost, and a value that half of all codes
    share (flat images) costs filings, not pairs.
    """
    crowd = CROWD if crowd is None else crowd
    d = F.bit_count(F.col("x").bitwiseXOR(F.col("y")))
    mine = own.where("near = 0").select("part", "value", F.col("code").alias("x"))
    theirs = all_.select("part", "value", F.col("code").alias("y"))
    n = theirs.groupBy("part", "value").agg(F.count("*").alias("n")).join(shuffled(mine.groupBy("part", "value").agg(F.count("*").alias("m"))), ["part", "value"])
    busy = materialize(n.where(F.col("n") * F.col("m") > crowd * crowd).select("part", "value"), "crowded")
    if busy.isEmpty():
        pairs = mine.join(shuffled(theirs), ["part", "value"])
    else:
        hot = lambda rows, c: materialize(rows.join(busy, ["part", "value"], "left_semi").select("part", "value", c), "crowded")
        again = _second_keys(hot(mine, "x"), hot(theirs, "y"), distance)
        calm = lambda rows: rows.join(busy, ["part", "value"], "left_anti")
        pairs = calm(mine).join(shuffled(calm(theirs)), ["part", "value"]).select("x", "y").unionAll(again)
    found = pairs.where("x <> y").where(d <= distance)
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), d.alias("d")).distinct()


def _second_keys(mine: DataFrame, theirs: DataFrame, distance: int) -> DataFrame:
    """mine and theirs: part, value and code (x, y) of crowded keys. x and y of all that meet under a second key, one of them its own."""
    if distance < 2:  # one part of all bits leaves none open
        return mine.join(shuffled(theirs), ["part", "value"]).select("x", "y")

    def again(rows: DataFrame, c: str) -> DataFrame:
        each = []
        for k, bits in enumerate(segments(distance)):
            rest = [b for b in range(64) if b not in set(bits)]
            each.append(rows.where(F.col("part") == k).select("part", "value", c, F.explode(_keys(F.col(c), rest, distance)).alias("k2")))
        return reduce(DataFrame.unionAll, each).select("part", "value", c, F.col("k2.part").alias("p2"), F.col("k2.value").alias("v2"), "k2.near")

    x, y = again(mine, "x"), again(theirs, "y")
    own, flipped = (x.where(F.col("near") == n).drop("near") for n in (0, 1))
    key = ["part", "value", "p2", "v2"]
    own = own.join(shuffled(y.drop("near")), key).select("x", "y")
    return own.unionAll(flipped.join(shuffled(y.where("near = 0").drop("near")), key).select("x", "y"))


def hamming_codes(codes: DataFrame, distance: int) -> DataFrame:
    """codes: longs. a < b and d of all pairs of distinct codes within the distance."""
    rows = filed(codes.select("code").distinct(), distance)
    return meeting(rows, rows, distance)


def hamming_pairs(df: DataFrame, id_: str, code: str, distance: int) -> DataFrame:
    """id_a < id_b and distance of all pairs of rows within it; rows of one code are paired as well, as this is asked for."""
    rows = df.select(F.col(id_).alias("id"), F.col(code).alias("code")).where("code is not null")
    near = hamming_codes(rows, distance)
    both = near.unionAll(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "d")).unionAll(rows.select(F.col("code").alias("a"), F.col("code").alias("b"), F.lit(0).alias("d")).distinct())
    left = rows.select(F.col("id").alias("id_a"), F.col("code").alias("a"))
    right = rows.select(F.col("id").alias("id_b"), F.col("code").alias("b"))
    return left.join(shuffled(both), "a").join(shuffled(right), "b").where("id_a < id_b").select("id_a", "id_b", F.col("d").cast("long").alias("distance"))


def best_match(df: DataFrame, index: DataFrame, id_: str, code: str, distance: int, order: str) -> DataFrame:
    """For each row, the closest index row but itself within the distance (lowest order among equals): id, match, distance. index has id_, code and order."""
    rows = df.select(F.col(id_).alias("id"), F.col(code).alias("a"))
    held = index.select(F.col(id_).alias("match"), F.col(code).alias("b"), F.col(order).alias("pos"))
    codes = rows.select(F.col("a").alias("code")).union(held.select("b")).where("code is not null").distinct()
    near = hamming_codes(codes, distance)
    near = near.unionAll(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "d")).unionAll(codes.select(F.col("code").alias("a"), F.col("code").alias("b"), F.lit(0).alias("d")))
    found = rows.join(shuffled(near), "a").join(shuffled(held), "b").where("id <> match")
    best = found.groupBy("id").agg(F.min(F.struct("d", "pos", "match")).alias("m"))
    return best.select("id", "m.match", F.col("m.d").cast("long").alias("distance"))


#: A slot's place in the index: stored ones by age, then new ones in processing order; sha256 breaks ties.
_SLOT = "struct<kind:int,rank:bigint,sha:string>"
_STATE = f"sha256 string, place struct<p:bigint,s:string>, status string, slot {_SLOT}"


def _both_ways(near: DataFrame, codes: DataFrame) -> DataFrame:
    """a, b and d of near codes in both directions, and of each code with itself."""
    flipped = near.select(F.col("b").alias("a"), F.col("a").alias("b"), "d")
    return near.select("a", "b", "d").unionAll(flipped).unionAll(codes.select(F.col("code").alias("a"), F.col("code").alias("b"), F.lit(0).alias("d")))


def _deciding(rows: DataFrame, held: DataFrame) -> DataFrame:
    """The rows whose fate isn't settled by their code: the first of each code that is not stored itself, and those that are.

    A later row of a code is always marked: whatever marked the first is still there and can't be taken by a smaller row,
    and if the first holds a slot, that slot is at distance 0.
    """
    own = rows.join(held.select("sha256"), "sha256", "left_semi")
    rest = rows.join(held.select("sha256"), "sha256", "left_anti")
    first = rest.groupBy("code").agg(F.min(F.struct("place", "sha256", "pixels")).alias("x")).select("x.sha256", "code", "x.pixels", "x.place")
    return first.unionByName(own.select("sha256", "code", "pixels", "place"))


def _settled(todo: DataFrame, by_new: DataFrame, by_stored: DataFrame) -> DataFrame:
    """The state of every row of todo (sha256, place): status new (a slot of its own), took (a stored row's slot) or marked.

    by_new: later, earlier and d. by_stored: sha256, place, old, slot, d and takes (whether the row is the larger one).
    Rounds: what is known of earlier rows bounds a row's best match from both sides, and it is settled once the bounds
    leave one answer. A stored slot changes hands at most once, to the first larger row that chooses it; who may still
    do so is a minimum per slot, so no pairs of rows that want one slot are made. The earliest open row has no open
    row before it, so every round settles one at least and there are no more rounds than rows; in practice as many as
    the longest chain of rows that wait for each other.
    """
    state = materialize(todo.select("sha256", "place", F.lit(None).cast("string").alias("status"), F.lit(None).cast(_SLOT).alias("slot")), "round")
    unknown = F.struct(F.lit(-1).alias("kind"), F.lit(0).cast("long").alias("rank"), F.lit("").alias("sha"))
    left = state.count()
    while left:
        open_ = state.where("status is null")
        wanted = by_stored.where("takes").join(open_.select("sha256"), "sha256", "left_semi").groupBy("old").agg(F.min("place").alias("threat"))
        gone = state.where("status = 'took'").groupBy(F.col("slot.sha").alias("old")).agg(F.min("place").alias("gone"))
        stored = by_stored.join(open_.select("sha256"), "sha256", "left_semi").join(wanted, "old", "left").join(gone, "old", "left")
        stored = stored.where(F.col("gone").isNull() | (F.col("gone") >= F.col("place"))).withColumn("sure", F.coalesce(F.col("threat") >= F.col("place"), F.lit(True)))
        stored = stored.select("sha256", "takes", "sure", "d", "slot")
        earlier = by_new.join(open_.select(F.col("sha256").alias("later")), "later", "left_semi")
        earlier = earlier.join(state.select(F.col("sha256").alias("earlier"), "status", "slot"), "earlier").where("status is null or status <> 'marked'")
        new = earlier.select(F.col("later").alias("sha256"), F.lit(False).alias("takes"), F.col("status").isNotNull().alias("sure"), "d", F.coalesce("slot", unknown).alias("slot"))
        key = F.struct("d", "slot")
        least = lambda when: F.min(F.when(when, key))
        seen = stored.unionByName(new).groupBy("sha256").agg(
            least(~F.col("takes") & F.col("sure")).alias("block"), least(~F.col("takes") & ~F.col("sure")).alias("block_maybe"),
            least(F.col("takes") & F.col("sure")).alias("take"), least(F.col("takes") & ~F.col("sure")).alias("take_maybe"),
        )
        below = lambda x, y: F.col(x).isNotNull() & (F.col(y).isNull() | (F.col(x) < F.col(y)))
        marked = below("block", "take") & below("block", "take_maybe")
        took = below("take", "block") & below("take", "block_maybe") & below("take", "take_maybe")
        alone = F.coalesce("block", "block_maybe", "take", "take_maybe").isNull()
        now = open_.select("sha256", "place").join(seen, "sha256", "left")
        status = F.when(marked, "marked").when(took, "took").when(alone, "new")
        fresh = F.struct(F.lit(1).alias("kind"), F.col("place.p").alias("rank"), F.col("sha256").alias("sha"))
        now = now.select("sha256", "place", status.alias("status"), F.when(took, F.col("take.slot")).when(alone, fresh).cast(_SLOT).alias("slot"))
        before, state = state, materialize(state.where("status is not null").select(now.columns).unionAll(now), "round")
        discard(before)
        was, left = left, state.where("status is null").count()
        if left >= was:
            raise RuntimeError("near duplicates: a round settled no row")
    return state


def mark(images: DataFrame, stored: DataFrame | None, cfg: Dedupe = Dedupe(), near: DataFrame | None = None) -> StageResult:
    """images: sha256, phash, width, height and provenance. stored: sha256, phash, width, height, pos (its index order). near: a, b and d of all near codes of both, if they are known (a stored index has them).

    Keeps every row, with duplicate_of and duplicate_distance; marked rows are also NEAR_DUPLICATE rejections.
    extras: supersessions (old, new, distance), stored rows that a newcomer with more pixels replaces. Rows without a
    code are kept unmarked. Exactly repeated rows of one sha256 share a mark.
    """
    none = {"duplicate_of": F.lit(None).cast("string"), "duplicate_distance": F.lit(None).cast("long")}
    if not cfg.enable:
        kept = images.withColumns(none)
        lost = rejection(kept.where("false"), "dedupe", F.lit("NEAR_DUPLICATE"), F.lit(""))
        return StageResult(kept, lost, {"supersessions": images.sparkSession.createDataFrame([], "old string, new string, distance long")})
    pixels = (F.col("width").cast("long") * F.col("height")).alias("pixels")
    place = F.struct((-F.col("pixels")).alias("p"), F.col("sha256").alias("s")).alias("place")
    rows = images.where("phash is not null").select("sha256", as_code("phash").alias("code"), pixels).distinct()
    rows = materialize(rows.select("sha256", "code", "pixels", place), "coded")
    held = stored.where("phash is not null").select("sha256", as_code("phash").alias("code"), pixels, F.col("pos").cast("long").alias("pos")).distinct() if stored is not None else rows.limit(0).select("sha256", "code", "pixels", F.lit(0).cast("long").alias("pos"))
    slot = F.struct(F.lit(0).alias("kind"), F.col("pos").alias("rank"), F.col("sha256").alias("sha"))
    held = materialize(held.select(F.col("sha256").alias("old"), "code", F.col("pixels").alias("old_pixels"), slot.alias("slot")), "stored")
    codes = materialize(rows.select("code").union(held.select("code")).distinct(), "codes")
    pairs = materialize(hamming_codes(codes, cfg.max_distance) if near is None else near.select("a", "b", "d"), "near")
    reach = _both_ways(pairs, codes)

    todo = materialize(_deciding(rows, held.select(F.col("old").alias("sha256"))), "deciding")
    at = lambda node, code: todo.select(F.col("sha256").alias(node), F.col("code").alias(code), F.col("place").alias(f"{node}_place"))
    by_new = reach.join(shuffled(at("later", "a")), "a").join(shuffled(at("earlier", "b")), "b").where("earlier_place < later_place").select("later", "earlier", "d")
    larger = (F.col("pixels") > F.col("old_pixels")) & F.lit(cfg.keep == "highest_resolution")
    by_stored = todo.withColumnRenamed("code", "a").join(shuffled(reach), "a").join(shuffled(held.withColumnRenamed("code", "b")), "b").where("sha256 <> old")
    by_stored = by_stored.select("sha256", "place", "old", "slot", "d", larger.alias("takes"))
    state = _settled(todo, materialize(by_new, "earlier"), materialize(by_stored, "beside"))

    # Who holds which slot from when to when; a row's match is the closest holder before it, the lowest slot among equals.
    holding = state.where("status <> 'marked'").join(todo.select("sha256", "code"), "sha256").select("sha256", "place", "status", "slot", "code")
    gone = holding.where("status = 'took'").groupBy(F.col("slot.sha").alias("old")).agg(F.min("place").alias("until"))
    nowhere = F.lit(None).cast("struct<p:bigint,s:string>")
    entries = holding.select(F.col("sha256").alias("holder"), F.col("code").alias("b"), "slot", F.col("place").alias("since"), nowhere.alias("until"))
    entries = entries.unionByName(held.join(gone, "old", "left").select(F.col("old").alias("holder"), F.col("code").alias("b"), "slot", nowhere.alias("since"), "until"))
    here = (F.col("since").isNull() | (F.col("since") < F.col("place"))) & (F.col("until").isNull() | (F.col("until") >= F.col("place"))) & (F.col("holder") != F.col("sha256"))
    found = rows.withColumnRenamed("code", "a").join(shuffled(reach), "a").join(shuffled(entries), "b").where(here)
    found = found.groupBy("sha256").agg(F.min(F.struct("d", "slot", "holder")).alias("m"))
    told = rows.select("sha256").distinct().join(found, "sha256", "left").join(state.select("sha256", "status"), "sha256", "left")
    told = told.withColumn("status", F.coalesce("status", F.lit("marked")))
    told = materialize(told.select("sha256", "status", F.col("m.holder").alias("holder"), F.col("m.d").cast("long").alias("distance")), "marks")
    marks = told.where("status = 'marked'").select("sha256", F.col("holder").alias("duplicate_of"), F.col("distance").alias("duplicate_distance"))
    kept = images.join(marks, "sha256", "left")
    lost = kept.where("duplicate_of is not null")
    detail = F.concat(F.lit("distance "), F.col("duplicate_distance"), F.lit(" from "), F.substring("duplicate_of", 1, 12))
    over = told.where("status = 'took'").select(F.col("holder").alias("old"), F.col("sha256").alias("new"), "distance")
    return StageResult(kept, rejection(lost, "dedupe", F.lit("NEAR_DUPLICATE"), detail), {"supersessions": over})


def as_code(phash: str) -> Column:
    """A hash of 16 hex digits as a long."""
    return F.conv(phash, 16, -10).cast("long")


def index_rows(images: DataFrame) -> DataFrame:
    """The stored index: coded rows that are no duplicates; pos is their age, of which sha256 breaks ties. No global sort: only rows of one component are ever ordered."""
    pos = F.unix_micros(F.col("created_at").cast("timestamp")).alias("pos")
    return images.where("phash is not null and duplicate_of is null").select("sha256", "phash", "class_label", "width", "height", pos)
