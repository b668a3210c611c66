"""Operators against plain versions written from their contracts."""

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gleaner.llm import chaining, decontaminate, knn_quality, mixing, pii, pseudo_likelihood, quality_rules, simhash, suffix_dedup, warc
from gleaner.plans.storage import new_path
from tests.conftest import DATA
from tests.llm.helpers import DOCS, odd_docs, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")


def _all(spark):
    """The small table and the odd rows that have an id of their own."""
    odd = odd_docs(spark).where("doc_id is not null").dropDuplicates(["doc_id"]).withColumn("doc_id", F.col("doc_id") + 100000)
    return _docs(spark).unionByName(odd)


# 1 ------------------------------------------------------------------------------------------------------------------
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def _pii(text):
    out = []
    for kind, p in PLAIN.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))) or (kind == "card" and 16 <= len(d) <= 19 and _luhn(d)) or (kind == "phone" and 8 <= len(d) <= 15)
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans(spark):
    odd = ["a@b.com_x@y.zz", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.004", "é\U0001f600 a@b.c +12345678", "9" * 20000, "a" * 20000, "a" * 3000 + "@b.c", "1 " * 9000, "4111 1111 1111 1111+1 (555) 123-4567"]
    docs = _all(spark).unionByName(spark.createDataFrame([(200000 + i, t, "en", "s", 1) for i, t in enumerate(odd)], DOCS))
    got = {r["doc_id"]: r["base"] for r in pii.personal_data(docs, ["doc_id"]).select("row.doc_id", pii._joined("base").alias("base")).collect()}
    assert got == {r["doc_id"]: ",".join(_pii(r["text"])) for r in docs.collect()}


def test_pii_contexts_discover(spark):
    """An identifier that no pattern matches is found where a context nearly always announces one."""
    made = [(i, f"{prose(20, i)} my address: user{i}@site.org thanks", "en", "s", 1) for i in range(60)]
    made += [(100 + i, f"{prose(20, i)} my address: h{i}[at]site.org thanks", "en", "s", 1) for i in range(4)]
    made += [(200 + i, f"{prose(20, i)} the user{i}[at]site.org of", "en", "s", 1) for i in range(4)]
    out = {r["doc_id"]: (r["base"], r["spans"]) for r in pii.personal_data(spark.createDataFrame(made, DOCS), ["doc_id"]).select("row.doc_id", pii._joined("base").alias("base"), pii._joined("spans").alias("spans")).collect()}
    text = dict((r[0], r[1]) for r in made)
    for i in range(100, 104):
        at = text[i].index("h" + str(i - 100) + "[at]")
        assert out[i] == ("", f"email:{at}:{at + len(f'h{i - 100}[at]site.org')}")
    assert all(out[i][1] == "" for i in range(200, 204))
    assert all(out[i][0] == out[i][1] for i in range(60))
    wide = pii.personal_data(spark.createDataFrame(made, DOCS), ["doc_id"])
    pii_more = pii.discovered(spark.createDataFrame(made, DOCS), pii.base_spans(spark.createDataFrame(made, DOCS), ["doc_id"]), broadcast_patterns=-1)
    assert pii_more.count() == 4 and wide.count() == len(made)


def _pii_graph(texts):
    """Spans that contexts add, by plain loops: instances and patterns scored in turn."""
    blank, seeds, loose = r"[\x20\x09-\x0D]", [], []

    def add(found, i, kind, name, text, start, end, before, behind):
        gap = text[before:start]
        if before and not re.match(blank, gap):
            gap = re.sub(f"^{blank[:1]}^{blank[1:]}+", "", gap)
        near = WORD.findall(gap.lower()) if re.search(blank + "$", gap) else []
        after = re.match(f"{blank[:1]}^{blank[1:]}*{blank}+({blank[:1]}^{blank[1:]}+)(?:{blank}|$)", text[end:behind])
        pats = [(1, *near[-1:])] * (len(near) > 0) + [(2, *near[-2:])] * (len(near) > 1) + ([(3, after[1].lower())] if after else [])
        found.append((i, kind, (kind, name), start, end, pats))

    for i, text in texts.items():
        base = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in _pii(text))]
        for kind, p in PLAIN.items():
            ms = list(re.finditer(p, text))
            for j, m in enumerate(ms):
                if (kind, m.start(), m.end()) in base:
                    name = m[0].lower() if kind == "email" else m[0] if kind == "ip" else re.sub("[^0-9]", "", m[0])
                    add(seeds, i, kind, name, text, m.start(), m.end(), ms[j - 1].end() if j else 0, ms[j + 1].start() if j + 1 < len(ms) else len(text))
        ms = [m for m in WORD.finditer(text) if re.search("[0-9@]", m[0])]
        for j, m in enumerate(ms):
            if any(s < m.end() and e > m.start() for _, s, e in base):
                continue
            lead = len(re.match(r"[^A-Za-z0-9+(]*", m[0])[0])
            name = re.sub(r"[^A-Za-z0-9)]+$", "", m[0][lead:])
            for kind, shape in pii.SHAPES.items():
                if name and re.search(shape, name):
                    inst = name.lower() if kind == "email" else re.sub("[:_-]", ".", name) if kind == "ip" else re.sub("[^0-9]", "", name)
                    add(loose, i, kind, inst, text, m.start(), m.end(), ms[j - 1].end() if j else 0, ms[j + 1].start() if j + 1 < len(ms) else len(text))
                    row = loose[-1]
                    loose[-1] = (*row[:3], m.start() + lead, m.start() + lead + len(name), [p for p in row[5] if lead == 0 or p[0] == 3])
    total = Counter()
    for text in texts.values():
        w = WORD.findall(text.lower())
        total.update([(1, x) for x in w] + [(3, x) for x in w] + [(2, a, b) for a, b in zip(w, w[1:])])
    known = {x[2]: 1.0 for x in seeds}
    while True:
        score = {}
        for kind in PLAIN:
            held = defaultdict(list)
            for x in seeds + loose:
                if x[1] == kind and x[2] in known:
                    for p in x[5]:
                        held[p].append(x[2])
            for p, xs in held.items():
                if len(set(xs)) >= pii.MIN_SUPPORT and sum(known[x] for x in xs) / total[p] >= pii.PATTERN_SCORE:
                    score[kind, p] = min(0.999, sum(known[x] for x in xs) / total[p])
        new = {x[2]: 1.0 for x in seeds}
        for inst in {x[2] for x in loose}:
            ps = {(x[1], p) for x in loose if x[2] == inst for p in x[5]} & set(score)
            value = 1 - np.prod([1 - score[p] for p in ps])
            if value >= pii.INSTANCE_SCORE:
                new[inst] = max(new.get(inst, 0), value)
        if new.keys() == known.keys() and all(abs(new[x] - known[x]) < 1e-9 for x in new):
            return {(i, kind, s, e) for i, kind, inst, s, e, _ in loose if inst in known}
        known = new


def test_pii_other_spellings_of_seeds_without_patterns(spark):
    docs = spark.createDataFrame([(1, "call +1 415 555 0100 now", "en", "a", 24), (2, "or (1)415.555.0100 then", "en", "a", 23)], DOCS)
    got = pii.personal_data(docs, ["doc_id"]).select("row.doc_id", pii._joined("spans").alias("spans"))
    assert {r["doc_id"]: r["spans"] for r in got.collect()} == {1: "phone:5:20", 2: "phone:3:18"}


def test_pii_graph_is_the_plain_one(spark):
    """Long texts, contexts far from other matches, patterns that only discovered instances stand in, other spellings of seeds."""
    texts = {i: f"{prose(60 + i, i)} my address: user{i}@site.org thanks {prose(60, 900 + i)}" for i in range(70)}
    texts |= {100 + i: f"{prose(80, i)} my address: h{i}[at]site.org thanks {prose(5, i)}" for i in range(12)}
    texts |= {200 + i: f"{prose(90, i)} please reach-out: h{i}[at]site.org" for i in range(12)}  # these instances induce a pattern
    texts |= {300 + i: f"{prose(70, i)} please reach-out: q{i}(at)far.net and" for i in range(2)}  # which finds others
    texts |= {400 + i: f"phone: +1 555 010 {1000 + i} {prose(30, i)}" for i in range(48)} | {450 + i: f"phone: 1555019{100 + i} {prose(30, i)}" for i in range(3)}
    texts |= {480: f"{prose(10, 3)} 1-555-010-1003 {prose(10, 4)}", 481: prose(10, 5) + " x9[at]no.where " + prose(10, 6), 482: "", 483: "1.2.3.400 " + "a" * 500 + " 7 " + "b" * 200}
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], DOCS)
    got = pii.discovered(docs, pii.base_spans(docs, ["doc_id"]))
    got = {(r["key"], r["kind"], r["start"], r["end"]) for r in got.collect()}
    want = _pii_graph(texts)
    assert got == want
    found = {i for i, *_ in want}
    assert {*range(100, 112), *range(200, 212), 300, 301, *range(450, 453), 480} <= found and 481 not in found


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "hi a@b.cd, +1 555 123 4567!", "en", "s", 0), (2, "none", "en", "s", 4)], DOCS)
    assert [r["text"] for r in pii.redacted(docs).orderBy("doc_id").collect()] == ["hi [EMAIL], [PHONE]!", "none"]


# 2 ------------------------------------------------------------------------------------------------------------------
def test_quality_votes_held_out(spark):
    d = "/root/testdata/sf0.01"
    scores = knn_quality.op2(spark, d)
    pdf = scores.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").toPandas()
    good, bad = pdf.score[pdf.quality == 1].to_numpy(), pdf.score[pdf.quality == 0].to_numpy()
    assert (good[:, None] > bad).mean() > 0.95
    assert scores.where("score < 0 or score > 1 or isnan(score)").count() == 0


def test_votes_are_exact_cosines():
    rng = np.random.default_rng(0)
    x, y = rng.random((40, 30)).astype(np.float32), (rng.random(40) > 0.5).astype(float)
    v = knn_quality.Voter(x, y)
    z = (x[:5] - v.mean) @ v.project
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    for i, row in enumerate(z):
        sims = v.vectors @ row
        near = np.argsort(-sims)[: knn_quality.NEIGHBOURS]
        w = np.maximum(sims[near], 1e-3).astype(float) ** knn_quality.SHARPNESS
        assert v.scores(x[:5])[i] == pytest.approx((w * y[near]).sum() / w.sum(), abs=1e-5)


# 3 ------------------------------------------------------------------------------------------------------------------
def test_shared_passages(spark):
    passage, other = prose(70, 500).split(), prose(60, 501).split()
    fuzzy = [w if i % 25 else "zzz" for i, w in enumerate(passage)]
    made = [(i, f"{prose(80, i)} {' '.join(passage)} {prose(50, 1000 + i)}") for i in range(30)]
    made += [(100 + i, f"{prose(40, 2000 + i)} {' '.join(fuzzy)} {prose(40, 3000 + i)}") for i in range(3)]
    made += [(200 + i, prose(150, 4000 + i)) for i in range(20)]
    made += [(300 + i, f"{prose(50, 5000 + i)} {' '.join(other)}") for i in range(2)]
    got = {r["doc_id"]: r for r in chaining.passage_classes(spark.createDataFrame(made, "doc_id long, text string").repartition(5)).collect()}
    assert {got[i]["class_id"] for i in [*range(30), 100, 101, 102]} == {0}
    assert all(got[i]["class_size"] == 33 and 60 <= got[i]["n_covered"] <= 80 for i in [*range(30), 100, 101, 102])
    assert all(got[200 + i]["class_id"] == 200 + i and got[200 + i]["class_size"] == 1 and got[200 + i]["n_covered"] == 0 for i in range(20))
    assert {got[300]["class_id"], got[301]["class_id"]} == {300}


def test_two_passages_with_other_text_between(spark):
    """Header and footer in common, the text between not: the chain over both is no passage, its parts are."""
    head, foot = prose(60, 510), prose(60, 511)
    made = [(i, f"{prose(30, 6000 + i)} {head} {prose(200, 6100 + i)} {foot} {prose(30, 6200 + i)}") for i in range(2)]
    exact, far = prose(45, 512).split(), [prose(150, 6300 + i).split() for i in range(2)]
    # An exact passage, then words that agree in fives, too few for the whole diagonal to be alike.
    made += [(10 + i, " ".join(exact + [w if k % 14 < 5 else far[i][k] for k, w in enumerate(prose(150, 513).split())])) for i in range(2)]
    got = {r["doc_id"]: r for r in chaining.passage_classes(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    assert [got[i]["class_id"] for i in (0, 1, 10, 11)] == [0, 0, 10, 10]
    assert all(120 <= got[i]["n_covered"] <= 125 for i in (0, 1)) and all(got[i]["longest"] >= 45 for i in (10, 11))


def test_recall_of_edited_passages(spark):
    """Passages with a word replaced in every few, alone and where six other texts, with smaller ids, quote stretches of them: of the pairs that a plain alignment finds, nine in ten and more share a class."""
    r, rows, kinds = random.Random(4), [], {}
    text = lambda n: prose(n, r.randrange(10**9))
    for size, gap in [(50, 8), (60, 6), (60, 10), (100, 6)]:
        for quoted in (False, True):
            for _ in range(12):
                i = len(kinds) * 20
                base = text(size).split()
                edited = list(base)
                for k in range(r.randrange(gap), size, gap):
                    edited[k] = f"edit{r.random()}"
                if chaining.common_words(base, edited) < chaining.MIN_WORDS or chaining.common_words(base, edited) < chaining.SIMILARITY * size:
                    continue
                kinds[100000 + i] = (size, gap, quoted)
                rows += [(100000 + i, f"{text(80)} {' '.join(base)} {text(50)}"), (100001 + i, f"{text(60)} {' '.join(edited)} {text(90)}")]
                for z in range(6 * quoted):
                    source, n = r.choice([base, edited]), r.randint(12, 30)
                    at = r.randrange(size - n)
                    rows.append((i + z, f"{text(40)} {' '.join(source[at : at + n])} {text(40)}"))
    got = {x["doc_id"]: x["class_id"] for x in chaining.passage_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    found = defaultdict(list)
    for i, kind in kinds.items():
        found[kind].append(got[i] == got[i + 1])
    assert len(found) == 8 and sum(map(sum, found.values())) >= 0.9 * len(kinds)
    assert all(sum(x) >= 0.75 * len(x) for x in found.values())
    assert all(c == i for i, c in got.items() if i < 100000), "quotes are no passages"


def test_passages_of_common_seeds(spark):
    """Every stretch of 24 words of a passage stands in ten texts with smaller ids, so each of its seeds, with either context, has a first holder that is neither of the two texts that share the passage."""
    rows, pairs = [], []
    for p in range(12):
        base = prose(56, 7000 + p).split()
        edited = [w if k % 14 != 9 else f"edit{p}x{k}" for k, w in enumerate(base)]
        for at in range(0, 33, 4):
            for source in (base, edited):
                rows += [(len(rows) + z, f"{prose(30, 8000 + len(rows) + z)} {' '.join(source[at : at + 24])} {prose(30, 20000 + len(rows) + z)}") for z in range(10)]
        pairs.append((90000 + 2 * p, 90001 + 2 * p))
        rows += [(i, f"{prose(50, 40000 + i)} {' '.join(t)} {prose(50, 60000 + i)}") for i, t in zip(pairs[-1], (base, edited), strict=True)]
    got = {r["doc_id"]: r["class_id"] for r in chaining.passage_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert all(got[a] == got[b] == a for a, b in pairs)
    assert all(c == i for i, c in got.items() if i < 90000)


def test_reach_equals_growth():
    """Many pairs at once against one pair's growth: never shorter, so no pair is ruled out that grows far enough."""
    rng = np.random.default_rng(8)
    x = rng.integers(2, 12, (300, 64)).astype(np.uint16)
    y = np.where(rng.random((300, 64)) < rng.random((300, 1)), x, rng.integers(2, 12, (300, 64))).astype(np.uint16)
    for k in range(0, 300, 3):
        y[k, 20:] = y[k, 18:-2].copy()
    sizes = rng.integers(0, 65, 300)
    for k in range(300):
        x[k, sizes[k] :] = 0
        y[k, sizes[-k - 1] :] = 1
    far = chaining.reach(x.T, y.T)
    for k in range(300):
        i, _ = chaining.grown(x[k][x[k] > 0].astype(np.uint32), y[k][y[k] > 1].astype(np.uint32), 1)
        assert far[k] >= i
    assert (far < 64).any()


def test_growth_past_edits():
    """The banded alignment against all alignments of all beginnings."""
    r = random.Random(12)
    for _ in range(60):
        x = [r.randrange(50) for _ in range(30)]
        y = list(x)
        for _ in range(r.randint(0, 4)):
            k = r.randrange(len(y))
            y[k : k + 1] = r.choice([[99], [], [y[k], 98]])
        for loss in (1, 3, 4):
            best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
            for i in range(len(x) + 1):
                for j in range(len(y) + 1):
                    ways = [0] if not i and not j else []
                    ways += [best[i - 1][j] - loss] * (i > 0) + [best[i][j - 1] - loss] * (j > 0)
                    if i and j:
                        ways.append(best[i - 1][j - 1] + (1 if x[i - 1] == y[j - 1] else -loss))
                    best[i][j] = max(ways)
            i, j = chaining.grown(np.array(x, np.uint32), np.array(y, np.uint32), loss)
            if loss == 1:  # never DROP under its best here
                assert best[i][j] == max(map(max, best))
            assert best[i][j] >= 0


def test_chain_is_the_best_one():
    """Scores of the Fenwick tree against all predecessors."""
    rng = random.Random(3)
    for _ in range(60):
        segs = np.array([(rng.randint(0, 60), rng.randint(0, 60), rng.randint(3, 9)) for _ in range(rng.randint(2, 14))])
        best = [0.0] * len(segs)
        order = sorted(range(len(segs)), key=lambda i: (segs[i][0], segs[i][1]))
        for i in order:
            a, b, n = segs[i]
            gains = [best[j] - chaining.GAP * (a - segs[j][0] - segs[j][2] + b - segs[j][1] - segs[j][2]) for j in order if segs[j][0] + segs[j][2] <= a and segs[j][1] + segs[j][2] <= b]
            best[i] = n + max([0.0, *gains])
        found = chaining.chains(segs)
        used = sum(e - s > 0 for s, e, *_ in found)
        assert used == len(found) <= len(segs)
        top = max(range(len(segs)), key=lambda i: best[i])
        assert any(e == segs[top][0] + segs[top][2] and be == segs[top][1] + segs[top][2] for _, e, _, be in found)


def test_common_words():
    rng = random.Random(1)
    for _ in range(100):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 30))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert chaining.common_words(a, b) == t[-1][-1]


# 4 ------------------------------------------------------------------------------------------------------------------
def _cut(pairs):
    seen, out = set(), {}
    for i, text in sorted(pairs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            if (w := raw[k : k + 100]) in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(w)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest())
    return out


def _check_cut(df):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.deduplicated(df).collect()}
    assert got == _cut([(r["doc_id"], r["text"]) for r in df.collect()])


def test_substrings(spark):
    _check_cut(_all(spark).repartition(3))


@pytest.mark.parametrize("name, value", [("CROWD", 2), ("PIECE", 333), ("BATCH", 2048)])
def test_substrings_through_other_paths(spark, monkeypatch, name, value):
    """Hot grams, texts that are cut in pieces, many small levels."""
    monkeypatch.setattr(suffix_dedup, name, value)
    r = random.Random(value)
    base = [prose(40, k) for k in range(8)]
    made = [(i, "".join((p := r.choice(base))[r.randint(0, 60) : len(p) - r.randint(0, 60)] for _ in range(r.randint(0, 5)))) for i in range(70)]
    _check_cut(spark.createDataFrame([*made, (200, "ab" * 400), (201, "x" * 700), (202, "x" * 99), (203, "x" * 100)], "doc_id long, text string").repartition(3))


def test_batches_one_after_another_equal_all_at_once(spark):
    """Passages within and across batches, with smaller ids in later batches; levels merge as they grow."""
    r, shared = random.Random(21), [prose(40, 70 + k) for k in range(6)]
    made = [(i, " ".join([prose(r.randint(5, 60), 500 + i), r.choice(shared), prose(20, 900 + i), r.choice(shared)[: r.randint(90, 200)]])) for i in range(48)] + [(50, None), (51, "short")]
    r.shuffle(made)
    family, got = suffix_dedup.StoredFamily(spark, new_path(spark, "family")), defaultdict(set)
    sizes = []
    for k in range(0, len(made), 10):
        batch = spark.createDataFrame(made[k : k + 10], "doc_id long, text string")
        for c in suffix_dedup.StoredFamily(spark, family.root).add(batch).collect():
            got[c["doc"]] |= set(range(c["start"], c["end"]))
        sizes.append([b - a + 1 for a, b, _ in family.levels()])
    own = suffix_dedup._identified(spark.createDataFrame(made, "doc_id long, text string"))
    want = defaultdict(set)
    for c in suffix_dedup.covers(own).collect():
        want[c["doc"]] |= set(range(c["start"], c["end"]))
    assert got == want and len(want) > 20
    assert sizes[0] == [1] and all(sum(x) == k + 1 for k, x in enumerate(sizes)) and len(sizes[-1]) < 5


def test_levels_merge_geometrically():
    family, rng = suffix_dedup.Family(), np.random.default_rng(2)
    seen = {}
    for k in range(40):
        keys = rng.integers(0, 3000, 100).astype(np.uint64)
        doc, start = np.full(100, 100 - k), np.arange(100)
        family.add(keys, [doc, np.zeros(100, np.int64), start, keys, keys])
        for key, s in zip(keys.tolist(), start.tolist(), strict=True):
            seen[key] = min(seen.get(key, (999, 0)), (100 - k, s))
    sizes = [len(keys) for keys, _ in family.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False)) and sum(sizes) == len(seen)
    at = family.rows()
    assert {int(family.columns[3][i]): (int(family.columns[0][i]), int(family.columns[2][i])) for i in at} == seen


# 5 ------------------------------------------------------------------------------------------------------------------
def test_warc_round_trip(spark):
    made = [(1, "a", "x WARC/1.1\r\n y\r\n\r\n WARC/1.1\r\nWARC/1.1\r\n"), (2, None, None), (3, "u\nv", ""), (4, "é", "é\U0001f600" * 3000), (5, "q", "é\U0001f600" * 3000), (None, "n", "zz"), (6, "", "zz"), (6, "", "zz"), (7, "x", "WARC/1.1\r\n" * 300), (8, "x", "\r\n\r\n"), (9, None, "lone")]
    path = new_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(made, "page_id long, url string, html string").repartition(3), path, size=1000)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, path).collect()), key=str)
    want = []
    for page, _, html in made:
        raw = (html or "").encode()
        first = min(p for p, _, h in made if p is not None and (h or "") == (html or ""))
        want.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if page == first else "revisit", None if page == first else first))
    assert got == sorted(want, key=str)
    segments = warc.read_segments(spark, path)
    assert segments.where("octet_length(payload) > 1000").count() == 0 and segments.where("segment > 1").count() > 0


def test_chunks_are_small_and_hold_no_version_line():
    r = random.Random(6)
    for _ in range(300):
        text = "".join(r.choice(["WARC/1.1\r\n", "WARC/1.", "é", "\U0001f600", "x" * r.randint(1, 30), "\r\n"]) for _ in range(r.randint(0, 20))).encode()
        size = r.randint(8, 40)
        ends = warc.cuts(memoryview(text), size)
        parts = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        assert b"".join(parts) == text and all(0 < len(p) <= size or not text for p in parts)
        assert all(b"WARC/1.1\r\n" not in p and p.decode() is not None for p in parts)


def test_warc_floor_and_joined_digests(spark):
    pages = spark.createDataFrame([(1, "a", "same"), (2, "a", "same"), (3, "a", "a longer payload"), (4, "a", "a longer payload")], "page_id long, url string, html string")
    kinds = lambda **kw: {v.split("WARC-X-Page: ")[1].split("\r")[0]: "revisit" if "WARC-Type: revisit" in v else "response" for (v,) in warc.chunks(pages, **kw).select("value").collect()}
    assert kinds(min_bytes=10) == {"1": "response", "2": "response", "3": "response", "4": "revisit"}
    assert kinds(broadcast_digests=0) == {"1": "response", "2": "revisit", "3": "response", "4": "revisit"}


# 6 ------------------------------------------------------------------------------------------------------------------
def _targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return fixed | share
        fixed |= {s: 2 * sizes[s] for s in over}
        free -= over
    return fixed


@pytest.mark.parametrize("buckets", [mixing.BUCKETS, 2])
def test_mixing(spark, monkeypatch, buckets):
    monkeypatch.setattr(mixing, "BUCKETS", buckets)
    docs = _all(spark)
    out = mixing.mixed(docs, ["doc_id"]).select("row.doc_id", "source", "size", "source_size", "target", "taken").toPandas()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(x.size_ == len(WORD.findall(text[x.doc_id] or "")) for x in out.rename(columns={"size": "size_"}).itertuples())
    want = _targets(out.groupby("source", dropna=False)["size"].sum().rename(index=lambda s: None if s != s else s).to_dict())
    for s, g in out.groupby("source", dropna=False):
        target = want[None if s != s else s]
        assert g.target.iloc[0] == pytest.approx(target) and abs(g.taken.sum() - target) <= 1 and g.source_size.iloc[0] == g["size"].sum()
    assert (out.taken <= 2 * out["size"]).all() and (out.taken >= 0).all()
    again = mixing.mixed(docs.repartition(7), ["doc_id"]).select("row.doc_id", "taken").toPandas()
    pairs = lambda x: sorted(zip(x.doc_id.fillna(-1), x.taken, strict=True))
    assert pairs(again) == pairs(out)


def test_reruns_agree_on_ties(spark):
    """Ids that repeat with other texts of equal weight, null ids and rows that are there twice, in other layouts."""
    made = [(k % 5 if k % 3 else None, f"word{k % 40:02d} " * (1 + k % 7), "ab"[k % 2]) for k in range(400)]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string")
    runs = []
    for n in (1, 3, 8):
        out = mixing.mixed(docs.repartition(n), ["doc_id", "text"]).select("row.doc_id", "row.text", "taken").collect()
        runs.append(sorted((r["doc_id"] or -1, r["text"], r["taken"]) for r in out))
        assert len(out) == 400
    assert runs[0] == runs[1] == runs[2]


def test_low_weights_fill_no_bucket(spark):
    weights = [1.0, 1 / 3, 1 / 21, 1 / 46]
    docs = spark.range(40000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    for w in weights:
        key = mixing.es_key("doc_id", mixing.text_md5("text"), F.lit(w))
        most = docs.groupBy(F.floor(key / (1 + key) * mixing.BUCKETS)).count().agg(F.max("count")).first()[0]
        assert most <= 200  # a bucket holds about 0.6 rows on average; the last ones of low weights a few dozens


# 7 ------------------------------------------------------------------------------------------------------------------
def _fingerprint(text, shingle=3):
    w = [x.decode("utf-8", "surrogatepass") for x in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())]
    grams = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    hs = np.array([xxhash.xxh64_intdigest(g.encode(), 42) for g in grams], np.uint64)
    return sum(1 << k for k in range(64) if int((hs >> np.uint64(k) & np.uint64(1)).sum()) * 2 > len(hs))


def _shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def _near_components(texts):
    """Links of whole fingerprints and of all pairs with a similarity of 0.8."""
    fps, sets = {i: _fingerprint(t, 5) for i, t in texts.items()}, {i: _shingles(t) for i, t in texts.items()}
    near = lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3 or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    return _components(fps, near)


def _components(fps, near=None):
    ids = list(fps)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if near(a, b) if near else (fps[a] ^ fps[b]).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for i in ids:
        least[root(i)] = min(least.get(root(i), i), i)
    return {i: least[root(i)] for i in ids}


def test_simhash(spark):
    docs = _all(spark)
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.simhash_components(docs).collect()}
    fps = {r["doc_id"]: _fingerprint(r["text"]) for r in docs.collect()}
    assert {i: f for i, (f, _) in got.items()} == fps
    assert {i: c for i, (_, c) in got.items()} == _components(fps)


@pytest.mark.parametrize("crowd", [simhash.CROWD, 1])
def test_links_lose_nothing(spark, crowd):
    """Clouds of fingerprints a few bits apart, paired and through hubs."""
    r = random.Random(crowd)
    fps = set()
    for _ in range(12):
        f = r.getrandbits(64)
        for _ in range(10):
            fps.add(f)
            for _ in range(r.randint(1, 3)):
                f ^= 1 << r.randrange(64)
    fps = dict(enumerate(sorted(fps)))
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in fps.items()], "fp long, node long")
    from gleaner.plans.components import components

    edges = simhash.links(nodes, crowd)
    assert all((fps[e["a"]] ^ fps[e["b"]]).bit_count() <= 3 for e in edges.collect())
    got = {i: i for i in fps} | {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == _components(fps)


def test_edited_copies_are_near(spark):
    """Copies with a word changed here and there, further apart than three bits, in groups with and without their original."""
    r, texts = random.Random(8), {}
    for g in range(6):
        base = prose(260, 7000 + g).split()
        texts[1000 * g + 500] = " ".join(base)
        for k in range(12):
            w = list(base)
            for _ in range(r.randint(1, 4)):
                w[r.randrange(len(w))] = f"edit{r.random()}"
            texts[1000 * g + k * 90] = " ".join(w)
    texts |= {90000 + k: prose(200, 7100 + k) for k in range(30)} | {95000 + k: prose(r.randint(1, 12), 7200 + k) for k in range(20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x["doc_id"]: x["component"] for x in simhash.near_copies(docs).collect()}
    want = _near_components(texts)
    pairs = lambda c: {(a, b) for a in c for b in c if c[a] == c[b]}
    assert pairs(got) == pairs(want)


def _check_near(spark, texts):
    got = {x["doc_id"]: x["component"] for x in simhash.near_copies(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    want = _near_components(texts)
    pairs = lambda c: {(a, b) for a in c for b in c if c[a] == c[b]}
    assert pairs(got) == pairs(want) and len(set(want.values())) < len(texts)


def test_copies_in_a_compilation_are_near(spark):
    """A text that holds all parts of two near copies does not stand between them; short edited texts have few parts."""
    r, texts = random.Random(9), {}

    def edited(words, n):
        w = list(words)
        for _ in range(n):
            w[r.randrange(len(w))] = f"edit{r.random()}"
        return " ".join(w)

    for g in range(6):
        base, rest = prose(200, 7300 + g).split(), prose(150, 7400 + g)
        a, b = edited(base, 2), edited(base, 2)
        texts |= {100 * g: f"{rest} {a} {rest} {b} {rest}", 100 * g + 1: a, 100 * g + 2: b, 100 * g + 3: f"{rest} {a} {rest} {b} {rest} {prose(300, 7500 + g)}"}
    _check_near(spark, texts)


def test_edited_copies_of_short_texts_are_near(spark):
    """Texts of 20 to 60 words, which have few parts, with their last word or another changed."""
    r, texts = random.Random(10), {}
    for g in range(40):
        base = prose(20 + g, 7600 + g).split()
        texts |= {10 * g: " ".join(base), 10 * g + 1: " ".join([*base[:-1], f"last{g}"])}
        base[r.randrange(len(base))] = f"edit{g}"
        texts[10 * g + 2] = " ".join(base)
    _check_near(spark, texts)


def test_parities_never_rule_out_a_similar_pair():
    """The bound stays at or under the true difference for sets of any sizes, and is over the limit for unrelated ones."""
    r = np.random.default_rng(11)
    for n in (0, 1, 5, 63, 64, 65, 127, 128, 1000, 5000):
        for m in {0, n // 2, n - n // 5, n, n + n // 4, 3 * n}:
            common = int(r.integers(0, min(m, n) + 1))
            x = np.unique(r.integers(0, 2**64 - 1, m + n, dtype=np.uint64))[: m + n - common]
            r.shuffle(x)
            a, b = x[:n], x[n - common :]
            true = len(np.setxor1d(a, b))
            assert simhash.least_difference(simhash.parity_bits(a), simhash.parity_bits(b)) <= true
    a, b = (simhash.parity_bits(r.integers(0, 2**64 - 1, 3000, dtype=np.uint64)) for _ in range(2))
    assert simhash.least_difference(a, b) > 6000 / 9


def _forms(n, some, seed):
    """Texts of so many out of 50 standard sentences."""
    r = random.Random(seed)
    sentences = [" ".join("".join(r.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(12)) for _ in range(50)]
    return {k: " ".join(sentences[i] for i in sorted(r.sample(range(50), some))) for k in range(n)}


def test_form_letters_make_few_proposals(spark, monkeypatch):
    made = []
    apart = simhash._apart
    monkeypatch.setattr(simhash, "_apart", lambda *a: made.append((out := apart(*a)).count()) or out)
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in _forms(600, 38, 4).items()], DOCS)
    assert simhash.keep_first(docs).count() >= 590 and made[0] < 20 * 600  # two may be alike by chance


def test_hot_shingles_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 30)
    monkeypatch.setattr(simhash, "PAIRS", 100)
    _check_near(spark, _forms(150, 46, 5))


def test_one_of_each_group_stays(spark):
    a, b = prose(300, 1), prose(300, 2)
    docs = spark.createDataFrame([(3, a, "en", "s", 1), (2, a, "en", "s", 1), (5, b, "en", "s", 1), (5, b, "en", "s", 1), (None, a, "en", "s", 1), (7, "", "en", "s", 0), (8, None, "en", "s", 0)], DOCS)
    assert sorted(r["doc_id"] for r in simhash.keep_first(docs).collect()) == [2, 5, 7]


# 8 ------------------------------------------------------------------------------------------------------------------
def _word_code(w):
    return xxhash.xxh3_64_intdigest(w.encode())


@pytest.mark.parametrize("common", [pseudo_likelihood.COMMON, 20])
def test_pseudo_likelihood(spark, monkeypatch, common):
    """Scores against plain sums over tokens, with rare words joined or broadcast; training helps."""
    monkeypatch.setattr(pseudo_likelihood, "COMMON", common)
    docs = _docs(spark).limit(300)
    texts = {r["doc_id"]: [w.decode() for w in (r["text"] or "").encode().lower().split()] for r in docs.collect()}
    first = pseudo_likelihood.untrained(docs)
    ids = pseudo_likelihood.encoded(docs, first)
    model = pseudo_likelihood.fitted(ids, first)
    counts = Counter(w for t in texts.values() for w in t)
    assert model.total == counts.total()
    own = {_word_code(w) for w in sorted(counts, key=lambda w: (-counts[w], _word_code(w) - (1 << 64) * (_word_code(w) >> 63)))[: pseudo_likelihood.OWN]}
    assert own == set(model.own.tolist())
    place = {c: k for k, c in enumerate(sorted(own))}
    shared = Counter()
    for w, n in counts.items():
        shared[_word_code(w) % 64] += n * (_word_code(w) not in own)
    net, some = model.net, {r["doc_id"]: r for r in pseudo_likelihood.scored(ids, model).collect()}
    for i in sorted(texts)[:6]:
        of = [place.get(_word_code(w), pseudo_likelihood.OWN + _word_code(w) % 64) for w in texts[i]]
        at = [pseudo_likelihood.PAD] * 2 + of + [pseudo_likelihood.PAD] * 2
        plain = sum(np.log(counts[w] / shared[_word_code(w) % 64]) for w in texts[i] if _word_code(w) not in own)
        for k, x in enumerate(of, 2):
            context = sum(net["embed"][j][at[k + o]] for j, o in enumerate(pseudo_likelihood._OFFSETS))
            z = context @ net["out"] + net["bias"]
            one, two = z[:32], z[32:] + net["second"][x // 32]
            plain += one[x // 32] - np.log(np.exp(one).sum()) + two[x % 32] - np.log(np.exp(two).sum())
        assert some[i]["n_tokens"] == len(of) and some[i]["log_prob"] == pytest.approx(plain, rel=1e-3, abs=1e-2)
    mean = lambda m: pseudo_likelihood.scored(ids, m).agg(F.sum("log_prob") / F.sum("n_tokens")).first()[0]
    assert mean(model) > mean(first) + 0.1


def test_layout_of_the_input_changes_no_score(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "SHARD", 3000)
    docs = _docs(spark).limit(120)
    scores = lambda d: sorted(map(str, _scores(d)))

    def _scores(d):
        model = pseudo_likelihood.untrained(d)
        ids = pseudo_likelihood.encoded(d, model)
        return pseudo_likelihood.scored(ids, pseudo_likelihood.fitted(ids, model)).collect()

    assert scores(docs.coalesce(1)) == scores(docs.repartition(7))


def test_copies_of_a_text_are_trained_in_many_shards(spark, monkeypatch):
    """No shard of training holds much more than its share, however often one text stands in the corpus."""
    monkeypatch.setattr(pseudo_likelihood, "SHARD", 2000)
    docs = spark.createDataFrame([(k, prose(100, 3 if k % 3 else k)) for k in range(600)], "doc_id long, text string")
    ids = pseudo_likelihood.encoded(docs, pseudo_likelihood.untrained(docs))
    dealt = ids.groupBy(F.pmod(F.xxhash64("order", "doc_id", F.lit("shard")), F.lit(8)).alias("shard")).agg(F.sum("n_tokens").alias("n")).collect()
    assert len(dealt) == 8 and max(r["n"] for r in dealt) < 2 * sum(r["n"] for r in dealt) / 8


def test_a_word_that_is_there_twice_scores_higher(spark):
    """Twins hold rare words that the corpus knows twice; others of the same make know theirs once."""
    r = random.Random(14)
    texts = [(k, " ".join(f"w{r.getrandbits(40):x}" if j % 3 else r.choice(["the", "of", "and"]) for j in range(60))) for k in range(240)]
    texts += [(1000 + k, texts[k][1]) for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = pseudo_likelihood.untrained(docs)
    ids = pseudo_likelihood.encoded(docs, model)
    got = {r["doc_id"]: r["mean_log_prob"] for r in pseudo_likelihood.scored(ids, pseudo_likelihood.fitted(ids, model)).collect()}
    least = min(got[k] for k in range(40))
    assert sum(got[k] < least for k in range(40, 240)) >= 190


def test_probabilities_sum_to_one():
    net = pseudo_likelihood.unpack(np.random.default_rng(1).normal(0, 1, sum(int(np.prod(s)) for s in pseudo_likelihood._SHAPES.values())))
    at = np.array([2])
    ids = np.array([3, 5, 0, 7, 9])
    total = 0.0
    for token in range(pseudo_likelihood.VOCAB):
        ids[2] = token
        total += np.exp(pseudo_likelihood.log_probs(net, ids, at)[0])
    assert total == pytest.approx(1, abs=1e-3)


def test_gradient():
    t = pseudo_likelihood.Trainer(pseudo_likelihood.start())
    words = pseudo_likelihood.codes(prose(200, 1), pseudo_likelihood.Codes())
    ids, at, _ = pseudo_likelihood.framed([pseudo_likelihood.ids_of(words, np.zeros(0, np.uint64))])
    before = pseudo_likelihood.log_probs(t.net, ids, at).mean()
    for _ in range(30):
        t.batch(ids, at)
    assert pseudo_likelihood.log_probs(t.net, ids, at).mean() > before + 1


# 9 ------------------------------------------------------------------------------------------------------------------
def _counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n, covered = Counter(wins), set()
    for i, x in enumerate(wins):
        if n[x] > 1:
            covered.update(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    docs = _all(spark)
    out = {r["doc_id"]: r for r in quality_rules.judged(docs, ["doc_id"]).select("row.doc_id", "*").drop("row").collect()}
    for r in docs.collect():
        got, (n, *rest) = out[r["doc_id"]], _counts(r["text"])
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == (n, *rest)
        failed = n < 20 or 100 * rest[-1] > 30 * n
        assert got["base_failed"] == failed and not (failed and got["kept"])


def test_quality_verdict(spark):
    d = "/root/testdata/sf0.01"
    out = quality_rules.op9(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").toPandas()
    good, bad = out[(out.quality == 1) & ~out.base_failed], out[out.quality == 0]
    assert good.kept.all() and bad.kept.mean() < 0.35


def test_js_distance(spark):
    def plain(p, q):
        p, q = np.array(p) / sum(p), np.array(q) / sum(q)
        m = (p + q) / 2
        kl = lambda x: sum(v * np.log2(v / w) for v, w in zip(x, m, strict=True) if v)
        return np.sqrt((kl(p) + kl(q)) / 2)

    rows = [([1, 2, 3], [3, 2, 1]), ([1, 0, 0], [0, 1, 0]), ([5, 5, 5], [1, 1, 1])]
    got = spark.createDataFrame(rows, "p array<int>, q array<int>").select(quality_rules.js_distance(F.col("p"), F.col("q")).alias("d")).collect()
    assert [r["d"] for r in got] == pytest.approx([plain(p, q) for p, q in rows], abs=1e-6)


# 10 -----------------------------------------------------------------------------------------------------------------
def test_masks_reach_every_pair_of_substitutions():
    from itertools import combinations

    whole = lambda n, bad: any(not {p + o for o in m} & set(bad) for m in decontaminate.MASKS for p in range(n - max(m)))
    assert all(whole(n, bad) for n in (10, 11, 12, 13) for bad in combinations(range(n), 2))
    assert all(whole(n, [bad]) for n in range(decontaminate.MASKED, 10) for bad in range(n))
    assert all(len({o % 5 for o in m}) < 5 for m in decontaminate.MASKS)


def _leaks(docs, items):
    """All diagonals of all pairs."""
    out = set()
    for i, text in docs:
        w = (text or "").lower().split()
        for j, item in items:
            v = (item or "").lower().split()
            if len(v) < 4:
                continue
            for s in range(-len(v), len(w)):
                equal = [0 <= s + k < len(w) and w[s + k] == x for k, x in enumerate(v)]
                n = min(13, len(v))
                if any(sum(equal[k : k + n]) >= (np.ceil(0.8 * n) if n > 5 else n) for k in range(len(v) - n + 1)):
                    out.add((i, j))
    return out


@pytest.mark.parametrize("broadcast", [decontaminate.BROADCAST_SEEDS, -1])
def test_leaks(spark, broadcast):
    items = [(k, prose(30, 900 + k)) for k in range(6)] + [(10, "a short item"), (11, prose(9, 950)), (12, None), (13, "four words and five"), (14, "these are five odd words"), (None, prose(20, 960))]
    made = [(i, prose(60, i)) for i in range(20)]
    for k in range(6):
        v = items[k][1].split()
        made += [(100 + k, f"{prose(30, k)} {' '.join(v)} {prose(20, 50 + k)}"), (200 + k, " ".join(v[8:])), (300 + k, " ".join(w if i % 5 else "zz" for i, w in enumerate(v))), (400 + k, prose(10, k) + " " + " ".join(v[:11]))]
    made += [(500, items[7][1].upper()), (501, None), (502, ""), (503, "one FOUR words and five more"), (504, "these are five odd words"), (505, "these are five other words"), (None, prose(20, 960)), (506, "a short item")]
    docs, bench = spark.createDataFrame(made, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench, broadcast).collect()}
    want = _leaks(made, items)
    assert got == want and {(300 + k, k) for k in range(6)} <= got and not {i for i, _ in got} & set(range(20))


def test_leaks_of_short_items_with_any_word_substituted(spark):
    items = [(n, prose(n, 1100 + n)) for n in range(4, 14)]
    made = []
    for n, text in items:
        for k in range(n):
            w = text.split()
            w[k] = "zz"
            made += [(1000 * n + 2 * k, f"{prose(8, k)} {' '.join(w)} {prose(5, k + 40)}"), (1000 * n + 2 * k + 1, " ".join(w[1:] if k == 0 else w[:-1] if k == n - 1 else w))]
    docs, bench = spark.createDataFrame(made, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == _leaks(made, items) and {(1000 * n + j, n) for n in range(6, 14) for j in range(2 * n)} <= got


@pytest.mark.parametrize("broadcast", [decontaminate.BROADCAST_SEEDS, -1])
def test_a_common_prompt_makes_few_hits(spark, monkeypatch, broadcast):
    prompt = "which of the following statements about it is true"
    items = [(k, f"{prompt} {prose(25, 2000 + k)}") for k in range(40)]
    made = [(k, f"{prose(20, 3000 + k)} {prompt} {prose(20, 4000 + k)}") for k in range(60)]
    w = items[7][1].split()
    made += [(100, " ".join([*w[:10], "zz", "zz", *w[12:13]])), (101, " ".join([*w[:9], "zz", *w[10:12], "zz", "zz"]))]
    rows, kept = {}, decontaminate.materialize

    def counted(df, name):
        out = kept(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(decontaminate, "materialize", counted)
    docs, bench = spark.createDataFrame(made, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench, broadcast).collect()}
    assert got == _leaks(made, items) and {(100, 7), (101, 7)} <= got and rows["hits"] < 62 * 40 // 10


# The pipeline -------------------------------------------------------------------------------------------------------
def test_pipeline_decides_as_its_parts(spark):
    import corpus_pipeline

    docs = corpus_pipeline.read(spark, DATA, "documents")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = [r.asDict() for r in docs.collect()]
        docs = corpus_pipeline.materialize(stage(spark, docs, DATA), "test")
        after = {r["doc_id"]: r.asDict() for r in docs.collect()}
        if k == 0:
            failed = {r["doc_id"] for r in before if (c := _counts(r["text"]))[0] < 20 or 100 * c[4] > 30 * c[0]}
            assert not failed & set(after) and len(after) > 0.7 * len(before)
        if k == 1:
            assert set(after) == set(_near_components({r["doc_id"]: r["text"] for r in before}).values())
        if k == 2:
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
            assert {r["doc_id"] for r in before} - set(after) == {i for i, _ in _leaks([(r["doc_id"], r["text"]) for r in before], items)}
        if k == 3:
            assert all(not _pii(r["text"]) and r["n_chars"] == len(r["text"]) for r in after.values())
            assert all(after[r["doc_id"]]["text"] == r["text"] for r in before if not _pii(r["text"]))
        if k == 4:
            groups = defaultdict(list)
            for r in after.values():
                groups[r["source"]].append(r)
            for g in groups.values():
                assert abs(sum(r["mix_taken"] for r in g) - g[0]["mix_target"]) <= 1
            assert set(after) == {r["doc_id"] for r in before}
    out = corpus_pipeline.run(spark, DATA)
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == sorted(after)


def test_pipeline_frees_only_what_was_read_again(spark, tmp_path):
    import corpus_pipeline

    stages = [stage for _, stage in corpus_pipeline.STAGES]
    source = corpus_pipeline.read(spark, DATA, "documents")
    kept = stages[0](spark, source, DATA)
    stages[1](spark, source, DATA)  # documents from before the first stage's tables
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    kept.write.parquet(str(tmp_path / "kept"))
    stages[1](spark, spark.read.parquet(str(tmp_path / "kept")), DATA)
    assert 0 not in corpus_pipeline._left and len(corpus_pipeline._left[1]) > 1
    assert ids == {r["doc_id"] for r in spark.read.parquet(str(tmp_path / "kept")).select("doc_id").collect()}


def test_op7_broadcasts_no_keys(spark):
    """Keys are 30 times the rows that Spark takes them for; the driver must not hold them."""
    nodes = spark.range(500).select(F.xxhash64("id").alias("fp"), F.col("id").alias("node"))
    for crowd in (96, 1):
        plan = simhash.links(nodes, crowd)._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_near_copies_broadcast_no_prefixes(spark, monkeypatch):
    """Rows of shingles are many times the texts that Spark takes them for."""
    plans, write = {}, simhash.materialize
    monkeypatch.setattr(simhash, "materialize", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().toString()) and None or write(df, name))
    docs = spark.createDataFrame([(k, f"one two three four five six seven {k // 2} and {k // 3} more") for k in range(30)], "doc_id long, text string")
    assert simhash.near_copies(docs).count() == 30
    assert all("BroadcastHashJoin" not in plans[name] for name in ("prefixes", "pairs", "keys"))


def test_base32_of_digests_is_computed_once(spark):
    """Against the standard library, and the plan names the hash once: each of 32 letters took a digest of its own where Spark repeats an expression."""
    texts = ["", "a", "é" * 300, "\r\n\r\n"] + [prose(20, k) for k in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "html string").select("html", warc.base32_sha1(F.col("html")).alias("d"))
    assert all(r["d"] == base64.b32encode(hashlib.sha1(r["html"].encode()).digest()).decode() for r in df.collect())
    assert df._jdf.queryExecution().optimizedPlan().toString().count("sha1(") == 1


def test_words_of_texts_are_counted_together():
    """Many texts at once against each by itself, as the model's encoding counts them."""
    rng = np.random.default_rng(3)
    text = np.sort(rng.integers(0, 20, 500))
    word = rng.integers(0, 2**64, 30, dtype=np.uint64)[rng.integers(0, 30, 500)]
    got = list(zip(*(x.tolist() for x in pseudo_likelihood.counted(text, word)), strict=True))
    want = [(k, w, n) for k in np.unique(text).tolist() for w, n in zip(*(x.tolist() for x in np.unique(word[text == k], return_counts=True)), strict=True)]
    assert got == want
    assert [len(x) for x in pseudo_likelihood.counted(text[:0], word[:0])] == [0, 0, 0]


def test_busy_keys_meet_their_row_once(spark):
    """Keys with over two rows are dealt out; every row meets its key's one row, others none."""
    from gleaner.plans.components import spread_join

    rows = spark.createDataFrame([(k, i) for k, n in ((1, 9), (2, 2), (3, 5), (4, 1)) for i in range(n)], "k long, i long")
    table = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 5)], "name string, k long")
    got = sorted((r["k"], r["i"], r["name"]) for r in spread_join(rows, table, "k", "i", heavy=2, salts=4).collect())
    assert got == [(k, i, name) for k, n, name in ((1, 9, "a"), (2, 2, "b"), (3, 5, "c")) for i in range(n)]
    joined = spread_join(rows, table, "k", "i", heavy=2, salts=4)._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count("LeftOuter") == 1, "only rows are flagged, the table is not"
