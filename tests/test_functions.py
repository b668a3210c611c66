"""Scalar semantics: tables of cases, and plain versions."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from gleaner.functions import licenses, scalars


def one(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


NAMES = {"by": "Attribution", "nc": "NonCommercial", "nd": "NoDerivs", "sa": "ShareAlike"}
SETS = [e for k in range(1, 5) for e in itertools.combinations(NAMES, k)]


def spdx(elements, version):
    return f"CC-{'-'.join(x.upper() for x in sorted(elements))}-{version or '4.0'}"


def written():
    """Every set of elements in every form of writing, with the identifier that the form's rule gives."""
    for n, (elements, version) in enumerate(itertools.product(SETS, ("", "1.0", "2.5", "3.0"))):
        turned = elements[n % len(elements) :] + elements[: n % len(elements)]
        end = [version] if version else []
        for sep in ("-", "_", " "):
            yield sep.join([*turned, *end]), spdx(elements, version)
            yield f"CC{sep}" + sep.join([*(x.upper() for x in turned), *end]), spdx(elements, version)
        names = "-".join(NAMES[x] for x in turned)
        yield f"\tCreative Commons {names} {version}\n", spdx(elements, version) if "by" in elements else None
        yield f"{names} {version}", None  # names without a mark of who grants it
        yield f"{'-'.join(turned)} {version} or later", None  # a code is a whole text
    for mark, found in (("cc0", "CC0-1.0"), ("CC-Zero", "CC0-1.0"), ("pdm", "PDM-1.0"), ("Public Domain", "PDM-1.0"), ("PD", "PDM-1.0")):
        for around in ("{}", "released: {}", "{} (checked)"):
            yield around.format(mark), found
        yield f"{mark} but non-commercial", None
        yield f"{mark}, no derivatives", None
    for none in ("", "  ", None, "teapot", "BYSA", "GFDL", "rights: ask"):
        yield none, None


def test_licences(spark):
    cases = list(written())
    assert one(spark, [t for t, _ in cases], licenses.normalise_license) == [found for _, found in cases]


def test_elements_and_gate(spark):
    ids = ["CC-BY-NC-SA-2.0", "CC0-1.0", "PDM-1.0", "CC-BY-4.0", "CC-SA-4.0"]
    assert [sorted(x) for x in one(spark, ids, licenses.license_elements)] == [["BY", "NC", "SA"], [], [], ["BY"], ["SA"]]
    assert one(spark, ids, lambda x: licenses.permits(x, ("NC", "ND"))) == [False, True, True, True, True]
    assert one(spark, ids, licenses.requires_attribution) == [True, False, False, True, False]


def test_deeds_and_ranks(spark):
    deeds = ["https://creativecommons.org/licenses/by-sa/3.0/", "//creativecommons.org/licenses/by-nc-nd", "https://creativecommons.org/publicdomain/zero/1.0/", "https://CreativeCommons.org/publicdomain/mark/1.0/", "https://a.b/"]
    assert one(spark, deeds, licenses.deed_license) == ["by-sa-3.0", "by-nc-nd", "cc0", "public domain", None]
    assert one(spark, ["CC BY-NC 4.0", "share alike", "by-4.0", "Public domain", "no derivs"], licenses.restrictiveness) == [3, 2, 1, 0, 3]


def test_scores_and_their_rounding(spark):
    shas = [hashlib.sha256(str(k).encode()).hexdigest() for k in range(200)]
    got = one(spark, shas, lambda x: scalars.split_score(x, "salt"))
    assert got == [int(hashlib.sha256(f"salt:{s}".encode()).hexdigest()[:16], 16) / 2**64 for s in shas]
    assert spark.sql("select cast(conv('ffffffffffffffff', 16, 10) as decimal(20,0)) d").select(F.col("d").cast("double") / F.lit(18446744073709551616.0)).first()[0] == 1.0


def test_halves_go_to_even(spark):
    df = spark.createDataFrame([(n,) for n in range(12)], "n long")
    assert [r[0] for r in df.select(scalars.fetch_limit(F.col("n"), 1.5)).collect()] == [max(0, round(n * 1.5)) for n in range(12)]


URLS = {
    "https://h/a/b.JPG?x=1.png": ".jpg", "https://h/a.b/c": ".bin", "https://h/x.jpeg": ".jpeg", "https://h/x.toolong": ".bin", "https://h/.hidden": ".bin", "https://h/x.": ".bin",
    "//h/x.png#y": ".png", "https://h.com": ".bin", "https://h/x.c": ".c",
}


def test_urls(spark):
    assert one(spark, URLS, scalars.url_extension) == list(URLS.values())
    assert one(spark, ["a.JPG?x", "a.svg", "a.tiff", "a?b.png"], scalars.is_image_url) == [True, False, True, False]
    assert one(spark, ["//u/thumb/a/ab/X.jpg/300px-X.jpg", "//u/a/X.jpg"], scalars.original_url) == ["https://u/a/ab/X.jpg", "https://u/a/X.jpg"]
    assert one(spark, ["https://h/wiki/File:A_b%2Bc+d.jpg", "https://h/wiki/File:100%_x.jpg"], scalars.title_of) == ["A b+c+d.jpg", "100% x.jpg"]
    assert one(spark, ["3", "1.5", "Wed, 21 Oct", None], scalars.retry_after) == [3.0, 1.5, None, None]


def test_credits(spark):
    long_ = " ".join(f"word{k}" for k in range(60))
    got = one(spark, ["Ola  Brandt ", " · K. Venn — ", "Archive VIAF 1", "Authority file", "", None, long_, "x" * 250], scalars.credit_line)
    assert got[:6] == ["Ola Brandt", "K. Venn", "Archive", None, None, None]
    assert got[6] == long_[:200].rsplit(" ", 1)[0] + "…" and got[7] == "x" * 200 + "…"


def test_hamming(spark):
    r = random.Random(1)
    pairs = [(f"{r.getrandbits(64):016x}", f"{r.getrandbits(64):016x}") for _ in range(50)] + [("000f", "0" * 16), ("f" * 16, "0" * 16)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in df.orderBy("i").select(scalars.hamming(F.col("a"), F.col("b"))).collect()]
    assert got == [(int(a, 16) ^ int(b, 16)).bit_count() if len(a) == len(b) else len(a) * 4 for a, b in pairs]


@pytest.mark.parametrize("split, format_, path, want", [("train", "JPEG", "/d/x.bin", "images/train/cat/s.jpg"), ("val", None, "/d/x.gif", "images/val/cat/s.gif"), ("val", "", "/d/x", "images/val/cat/s.jpg")])
def test_relative_path(spark, split, format_, path, want):
    df = spark.createDataFrame([(split, "cat", "s", format_, path)], "split string, l string, s string, f string, p string")
    assert df.select(scalars.relative_path(F.col("split"), F.col("l"), F.col("s"), F.col("f"), F.col("p"))).first()[0] == want
