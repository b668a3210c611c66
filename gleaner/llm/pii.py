"""Personal data: fixed patterns first, then identifiers that bootstrapped contexts discover.

Native: DataFrame functions only.

Base spans are leftmost non-overlapping matches per kind over the whole text, in code points, end exclusive; a match
that fails its check (octets over 255, Luhn, number of digits) is dropped and not retried. The patterns below match
the same strings as the plain ones; look-behinds and possessive groups only keep the search linear on long runs.

Bootstrapping. Seeds are the base spans: instances (kind and normalised identifier) of certain confidence. Patterns are
lexical contexts: the last whole word before a span, the last two, and the first whole word behind it. Candidates are
words with a digit or an at sign that overlap no base span and have the loose shape of a kind. Instances and patterns
form a bipartite graph, scored in rounds until nothing changes (MAX_ROUNDS at most):
    pattern  = sum of its instances' confidence over their occurrences / occurrences of its words in the whole corpus
    instance = 1 - product of (1 - pattern) over its patterns of PATTERN_SCORE or more
A pattern counts in a round if MIN_SUPPORT different known instances stand in it: seeds, and what earlier rounds have
discovered (INSTANCE_SCORE or more), which so induces patterns that no seed stands in. A candidate that is a seed's
instance in another spelling is known from the start. At the end all occurrences of known instances are spans. So a
context counts only if it nearly always announces an identifier.

The patterns' hashes are broadcast only after they were counted and are BROADCAST_PATTERNS at most; else they are
joined by hash. Contexts end at the match before of the same kind; a word that it cuts is none.

Defined results: null and empty texts have no spans; repeated rows get the same spans; ids may be null; other columns
pass through, whatever their names; no length bounds a span or a candidate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.texts import read, row_key, words
from gleaner.plans.storage import materialize, scratch

# Kinds in their order, with the pattern of each.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD_WITH_SIGN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
WORD_START = r"^[^\x20\x09-\x0D]+"
WORD_BEHIND = r"^[^\x20\x09-\x0D]*+[\x20\x09-\x0D]++([^\x20\x09-\x0D]++)(?:[\x20\x09-\x0D]|$)"
# Loose shapes of candidates.
SHAPES = {
    "email": r"^[^@]+(@|[(\[]at[)\]])[^@]+$",
    "ip": r"^[0-9]{1,3}([.:_-][0-9]{1,3}){3}$",
    "card": r"^[0-9](-?[0-9]){11,18}$",
    "phone": r"^[+(]?[0-9]([().-]{0,2}[0-9]){6,14}$",
}
MAX_ROUNDS = 12
MIN_SUPPORT = 5
PATTERN_SCORE = 0.8
INSTANCE_SCORE = 0.9
BROADCAST_PATTERNS = 200_000
#: Patterns of single words up to which other words are left out before they are counted, so that the whole vocabulary is not shuffled.
FEW_PATTERNS = 1000
#: Characters before a span in which its context is looked for first; the whole gap is read if they hold under three blanks.
REACH = 120
#: Discovered rows up to which they are broadcast to the documents.
BROADCAST_SPANS = 100_000
BLANK = r"[\x20\x09-\x0D]"
SPAN = "array<struct<start:int,end:int,hit:string,near:string,after:string>>"


def _luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _passes(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(r"^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(_digits(hit)).between(16, 19) & F.when(F.length(_digits(hit)).between(16, 19), _luhn(_digits(hit))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(hit)).between(8, 15)
    return F.lit(True)


def _matches(df: DataFrame, name: str, pattern: str, guard: Column) -> DataFrame:
    """Adds an array of start, end, hit, near (what stands before the hit, since the last, from a whole word on) and after (the first whole word behind it)."""
    df = df.withColumn("_h", F.when(guard, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))))
    some = F.size("_h") > 0
    df = df.withColumn("_g", F.when(some, F.split("text", pattern, -1)))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, i: Column) -> Column:
        gap, hit = F.get("_g", i), F.get("_h", i)
        start = acc["at"] + F.length(gap)
        tail = F.right(gap, F.lit(REACH))
        few = (F.length(gap) <= REACH) | (F.regexp_count(tail, F.lit(BLANK + "+")) < 3)
        whole = F.when(few & (acc["at"] == 0), gap).otherwise(F.regexp_replace(F.when(few, gap).otherwise(tail), WORD_START, ""))
        after = F.regexp_extract(F.coalesce(F.get("_g", i + 1), F.lit("")), WORD_BEHIND, 1)
        span = F.struct(start.alias("start"), (start + F.length(hit)).alias("end"), hit.alias("hit"), whole.alias("near"), after.alias("after"))
        return F.struct((start + F.length(hit)).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    spans = F.aggregate(F.sequence(F.lit(0), F.size("_h") - 1), zero, step)["out"]
    return df.withColumn(name, F.coalesce(F.when(some, spans), F.array().cast(SPAN))).drop("_h", "_g")


def base_spans(docs: DataFrame, carry: list[str]) -> DataFrame:
    """row (the carried columns), key, an array of spans for each kind, and loose, the candidates."""
    row = F.struct(*[F.col(f"`{c}`") for c in carry])
    df = docs.select(row.alias("row"), row_key(docs).alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    signs = F.col("text").rlike("[0-9]")
    guards = {"email": F.contains("text", F.lit("@")), "ip": signs, "card": signs, "phone": signs & F.contains("text", F.lit("+"))}
    for kind, pattern in KINDS.items():
        df = _matches(df, kind, pattern, guards[kind])
        df = df.withColumn(kind, _passing(kind))
    df = _matches(df, "loose", WORD_WITH_SIGN, F.col("text").rlike("[0-9@]"))
    all_ = F.concat(*KINDS)
    df = df.withColumn("_all", F.transform(all_, lambda x: F.struct(x["start"], x["end"])))
    free = lambda x: ~F.exists("_all", lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"]))
    df = df.withColumn("loose", F.filter("loose", free))
    return df.drop("text", "_all")


def _passing(kind: str) -> Column:
    return F.filter(kind, lambda x: _passes(kind, x["hit"]))


def _contexts(near: Column, after: Column) -> Column:
    """Patterns as sort and hash: 1 of the last word before the hit, 2 of the last two (none unless a blank separates them), 3 of the first behind it."""
    parts = words(F.lower(near))
    apart = near.rlike(BLANK + "$")
    one, two = F.get(parts, F.size(parts) - 1), F.get(parts, F.size(parts) - 2)
    made = [(apart & one.isNotNull(), 1, [F.xxhash64(one)]), (apart & two.isNotNull(), 2, [F.xxhash64(two), F.xxhash64(one)]), (F.length(after) > 0, 3, [F.xxhash64(F.lower(after))])]
    return F.array_compact(F.array(*[F.when(there, F.struct(F.lit(k).alias("sort"), F.xxhash64(F.lit(k), *of).alias("pat"))) for there, k, of in made]))


def _occurrences(found: DataFrame) -> DataFrame:
    """key, kind, inst, start, end, seed, pats: a row for each base span, and for each candidate and kind it has the shape of."""
    seeds = F.concat(*[F.transform(k, _tag(k)) for k in KINDS])
    seeds = found.select("key", F.explode(seeds).alias("x")).select("key", "x.kind", F.lower("x.hit").alias("id"), "x.start", "x.end", F.lit(True).alias("seed"), "x.near", "x.after")
    loose = found.select("key", F.explode("loose").alias("x")).select("key", "x.*")
    loose = loose.withColumn("lead", F.length(F.regexp_extract("hit", r"^[^A-Za-z0-9+(]*", 0))).withColumn("id", F.regexp_replace(F.expr("substring(hit, lead + 1)"), r"[^A-Za-z0-9)]+$", ""))
    kinds = F.array_compact(F.array(*[F.when(F.col("id").rlike(shape), F.lit(k)) for k, shape in SHAPES.items()]))
    loose = loose.where(F.length("id") > 0).select("key", F.explode(kinds).alias("kind"), F.lower("id").alias("id"), (F.col("start") + F.col("lead")).alias("start"), (F.col("start") + F.col("lead") + F.length("id")).alias("end"), F.lit(False).alias("seed"), F.when(F.col("lead") == 0, F.col("near")).alias("near"), "after")
    both = seeds.unionByName(loose)
    plain = F.when(F.col("kind") == "email", F.col("id")).when(F.col("kind") == "ip", F.translate(F.col("id"), ":_-", "...")).otherwise(_digits(F.col("id")))
    pats = _contexts(F.coalesce("near", F.lit("")), F.coalesce("after", F.lit("")))
    return both.select("key", "kind", F.xxhash64("kind", plain).alias("inst"), "start", "end", "seed", pats.alias("pats"))


def _tag(kind: str):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x["hit"].alias("hit"), x["start"].alias("start"), x["end"].alias("end"), x["near"].alias("near"), x["after"].alias("after"))


def _totals(docs: DataFrame, pats: DataFrame, small: bool) -> DataFrame:
    """pat and total: how often its words stand in all texts. Single words are counted before they meet the patterns, so no occurrence of a common word is a row of the join; pairs, which are too many to count all, meet a broadcast of the patterns first."""
    df = docs.select(F.transform(words(F.lower("text")), lambda w: F.xxhash64(w)).alias("h")).where(F.size("h") > 0)
    ones, kinds = df.select(F.explode("h").alias("h")), (F.xxhash64(F.lit(1), "h"), F.xxhash64(F.lit(3), "h"))
    if small and (few := [r["pat"] for r in pats.where("sort <> 2").select("pat").distinct().limit(FEW_PATTERNS + 1).collect()]) and len(few) <= FEW_PATTERNS:
        ones = ones.where(kinds[0].isin(few) | kinds[1].isin(few))
    ones = ones.groupBy("h").agg(F.count("*").alias("total"))
    ones = ones.select(F.explode(F.array(*kinds)).alias("pat"), "total")
    pairs = df.select(F.explode(F.zip_with("h", F.slice("h", 2, F.greatest(F.size("h") - 1, F.lit(0))), lambda x, y: F.when(y.isNotNull(), F.xxhash64(F.lit(2), x, y)))).alias("pat")).where("pat is not null")
    known = F.broadcast(pats) if small else pats
    of_words = ones.join(known.where("sort <> 2"), "pat").select("pat", "total")
    two = known.where("sort = 2").select("pat")
    if pats.where("sort = 2").isEmpty():
        return of_words
    count = F.count("*").alias("total")
    return of_words.unionByName(pairs.join(two, "pat").groupBy("pat").agg(count) if small else pairs.groupBy("pat").agg(count).join(two, "pat"))


def discovered(docs: DataFrame, found: DataFrame, broadcast_patterns: int = BROADCAST_PATTERNS) -> DataFrame:
    """key, kind, start and end of the spans that the contexts add."""
    occ = materialize(_occurrences(found), "occurrences")
    edges = occ.select("kind", "inst", "seed", F.explode("pats").alias("x")).select("kind", "inst", "seed", "x.sort", "x.pat")
    # A pattern that too few instances of any sort stand in, or no candidate, can discover nothing in any round.
    counted = edges.groupBy("kind", "sort", "pat", "inst", "seed").agg(F.count("*").alias("n"))
    able = counted.groupBy("kind", "sort", "pat").agg(F.count_distinct("inst").alias("insts"), F.bool_and("seed").alias("seeds"), F.sum("n").alias("n")).where((F.col("insts") >= MIN_SUPPORT) & ~F.col("seeds"))
    able = materialize(able.select("kind", "sort", "pat", "n"), "patterns")
    pats = able.select("sort", "pat").distinct()
    n_pats = pats.count()
    known = seeds = occ.where("seed").select("kind", "inst").distinct().withColumn("score", F.lit(1.0))
    if n_pats:
        totals = materialize(_totals(docs, pats, n_pats <= broadcast_patterns), "totals")
        # Were all its instances known, a pattern's score would be n / total; one that stays under the bar then can't count in any round.
        live = able.join(totals, "pat").where(F.col("n") >= PATTERN_SCORE * F.col("total")).select("kind", "pat", "total")
        known = _scored(seeds, materialize(counted.join(live, ["kind", "pat"]), "graph"))
    return occ.where("not seed").join(known.select("kind", "inst"), ["kind", "inst"], "left_semi").select("key", "kind", "start", "end").distinct()


def _scored(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """kind, inst and score of what is known when the rounds end: the seeds and what the graph's patterns discover."""
    if links.isEmpty():
        return seeds
    known, mark = seeds, None
    for _ in range(MAX_ROUNDS):
        scored = links.join(known, ["kind", "inst"]).groupBy("kind", "pat").agg((F.sum(F.col("score") * F.col("n")) / F.max("total")).alias("p"), F.count_distinct("inst").alias("support"))
        scored = scored.where((F.col("p") >= PATTERN_SCORE) & (F.col("support") >= MIN_SUPPORT)).withColumn("p", F.least("p", F.lit(0.999)))
        new = links.where("not seed").join(scored, ["kind", "pat"]).groupBy("kind", "inst").agg((1 - F.exp(F.sum(F.log(1 - F.col("p"))))).alias("score")).where(F.col("score") >= INSTANCE_SCORE)
        known = materialize(seeds.unionByName(new).groupBy("kind", "inst").agg(F.max("score").alias("score")), "known")
        state = known.agg(F.count("*"), F.round(F.sum("score"), 6)).first()
        if state == mark:
            break
        mark = state
    return known


def personal_data(docs: DataFrame, carry: list[str]) -> DataFrame:
    """row, key, base (an array of kind, start and end, in order), spans (the same with what was discovered)."""
    found = materialize(base_spans(docs, carry), "pii")
    with scratch(docs.sparkSession) as keep:
        more = materialize(discovered(docs, found).groupBy("key").agg(F.collect_list(F.struct(_order("kind").alias("k"), "kind", "start", "end")).alias("more")), "discovered")
        keep.append(more)
    more = F.broadcast(more) if (more.select(F.sum(F.size("more"))).first()[0] or 0) <= BROADCAST_SPANS else more
    base = F.concat(*[F.transform(kind, _plain(k, kind)) for k, kind in enumerate(KINDS)])
    out = found.join(more, "key", "left").withColumn("base", base)
    return out.withColumn("spans", F.sort_array(F.concat("base", F.coalesce("more", F.expr("cast(array() as array<struct<k:int,kind:string,start:int,end:int>>)")))))


def _order(kind: str) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), F.col(kind)).cast("int") - 1


def _plain(k: int, kind: str):
    return lambda x: F.struct(F.lit(k).alias("k"), F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op1(spark, sf_dir: str) -> DataFrame:
    out = personal_data(read(spark, sf_dir, "documents"), ["doc_id"])
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("row.doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """docs with each span of text replaced by its kind in brackets; spans that overlap give one replacement."""
    out = personal_data(docs, docs.columns)
    text = F.col("row.text")
    order = F.sort_array(F.transform("spans", lambda x: F.struct(x["start"], x["end"], x["kind"])))

    def step(acc: Column, x: Column) -> Column:
        new = x["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        more = F.when(new, F.concat(acc["out"], gap, F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), more.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    end = lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))
    clean = F.when(F.size("spans") > 0, F.aggregate(order, zero, step, end)).otherwise(text)
    out = out.select("row", clean.alias("clean"))
    same = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return out.select(*[same.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def base_columns(spark, sf_dir: str) -> DataFrame:
    """The columns of op1 that the fixed patterns alone decide."""
    return op1(spark, sf_dir).drop("spans")


def _sql_hits(kind: str, order: int, pattern: str) -> str:
    return f"SELECT r, '{kind}' AS kind, {order} AS o, regexp_extract_all(t, '{pattern}') AS h, regexp_split_to_array(t, '{pattern}') AS g FROM d"


# The plain patterns of the kinds.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BASE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_sql_hits(kind, k, pattern) for k, (kind, pattern) in enumerate(_PLAIN.items()))}),
i AS (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM m WHERE len(h) > 0),
s AS (SELECT r, kind, o, h[i] AS hit, regexp_replace(h[i], '[^0-9]', '', 'g') AS digits,
    (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start FROM i),
ok AS (SELECT *, CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(hit, '.'), lambda x: x::HUGEINT > 255)) = 0
    WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15
    ELSE length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(0, length(digits)), lambda k:
      CASE WHEN k % 2 = 0 THEN substr(digits, (length(digits) - k)::BIGINT, 1)::INT
        WHEN substr(digits, (length(digits) - k)::BIGINT, 1)::INT > 4 THEN 2 * substr(digits, (length(digits) - k)::BIGINT, 1)::INT - 9
        ELSE 2 * substr(digits, (length(digits) - k)::BIGINT, 1)::INT END)) % 10 = 0 END AS good FROM s),
f AS (SELECT r, count_if(kind = 'email') AS n_email, count_if(kind = 'ip') AS n_ip, count_if(kind = 'card') AS n_card, count_if(kind = 'phone') AS n_phone,
    string_agg(kind || ':' || start || ':' || (start + length(hit)), ',' ORDER BY o, start) AS spans FROM ok WHERE good GROUP BY r)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card, coalesce(n_phone, 0)::BIGINT AS n_phone,
  sha256(coalesce(spans, '')) AS base_sha256 FROM d LEFT JOIN f ON d.r = f.r
"""
