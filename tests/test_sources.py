"""Pages, payloads, bytes and requests."""

import http.server
import json
import struct
import threading
import urllib.error
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.config import Http
from gleaner.sources import api, html, http as fetch, images

FOOTER = '<div id="footer" class="mw-footer">Text is under <a href="https://creativecommons.org/licenses/by-sa/4.0/">Creative Commons Attribution-ShareAlike</a></div>'


def page(boxes="", author="Ola Brandt", link='<div class="fullImageLink"><a href="//up.org/a/X.jpg">full</a></div>', label="Author"):
    return f'<html><body><div id="mw-content-text">{link}<table><tr><td class="fileinfo-paramfield">Description</td><td>long prose</td></tr><tr><td class="fileinfo-paramfield">{label}</td><td>{author}</td></tr></table>{boxes}</div>{FOOTER}</body></html>'


CC = '<div class="licensetpl"><a href="https://creativecommons.org/licenses/{}/">deed</a><span class="licensetpl_short">short</span></div>'
PAGES = {
    "File:cc.jpg": (page(CC.format("by-sa/3.0")), ("by-sa-3.0", "https://creativecommons.org/licenses/by-sa/3.0/")),
    "File:pd.jpg": (page('<div class="licensetpl">This is in the public domain</div>'), ("Public domain", None)),
    "File:short.jpg": (page('<div class="licensetpl"><span class="licensetpl_short">GFDL</span></div>'), ("GFDL", None)),
    "File:two.jpg": (page('<div class="licensetpl">public domain</div>' + CC.format("by-nc-nd/4.0")), ("by-nc-nd-4.0", "https://creativecommons.org/licenses/by-nc-nd/4.0/")),
    "File:zero.jpg": (page('<div class="licensetpl"><a href="//creativecommons.org/publicdomain/zero/1.0/">z</a></div>'), ("cc0", "https://creativecommons.org/publicdomain/zero/1.0/")),
}


def scrape(spark, pages):
    df = spark.createDataFrame([(u, h, "cat") for u, h in pages], "url string, html string, class_label string").withColumn("fetched_at", F.current_timestamp())
    return html.scraped_records(df)


def test_boxes_answer_and_the_footer_never_does(spark):
    out = scrape(spark, [(f"https://h/wiki/{u}", h) for u, (h, _) in PAGES.items()] + [("https://h/wiki/File:none.jpg", page())])
    got = {r["source_id"].rpartition("/")[2]: (r["license_raw"], r["license_url"]) for r in out.kept.collect()}
    assert got == {u: want for u, (_, want) in PAGES.items()}
    assert [(r["reason_code"], r["source_id"]) for r in out.rejections.collect()] == [("MISSING_LICENSE", "https://h/wiki/File:none.jpg")]
    row = out.kept.where("source_id like '%cc.jpg'").first()
    assert (row["image_url"], row["attribution"], row["title"]) == ("https://up.org/a/X.jpg", "Ola Brandt", "cc.jpg")
    assert json.loads(row["payload"])["scraped_from"] == "html"


def test_previews_authors_and_missing_images(spark):
    thumb = '<div id="file"><img src="//up.org/thumb/a/ab/X.png/300px-X.png"></div>'
    pages = [("https://h/wiki/File:t.jpg", page(CC.format("by/2.0"), "A. Name<br>1900 births VIAF 12", thumb, "Photographer")), ("https://h/wiki/File:n.jpg", page(CC.format("by/2.0"), link="")), ("https://h/wiki/File:d.jpg", page(CC.format("by/2.0"), "x", label="Date")), ("https://h/wiki/File:null.jpg", None)]
    out = scrape(spark, pages)
    got = {r["title"]: (r["image_url"], r["attribution"]) for r in out.kept.collect()}
    assert got == {"t.jpg": ("https://up.org/a/ab/X.png", "A. Name 1900 births"), "d.jpg": ("https://up.org/a/X.jpg", None)}
    assert {r["reason_code"] for r in out.rejections.collect()} == {"MISSING_IMAGE_URL"}


def test_categories(spark):
    gallery = '<ul id="mw-category-media">' + "".join(f'<li class="gallerybox"><a href="/wiki/File:{n}">x</a><a href="/wiki/File:other.jpg">y</a></li>' for n in ("a.jpg", "b.svg", "c%20d.PNG", "a.jpg")) + "</ul>"
    cats = '<div id="mw-subcategories">' + "".join(f'<a href="/wiki/Category:{c}">x</a>' for c in ("Teapots", "Cats_by_country", "Teapots", "Cats")) + "</div>"
    more = '<a href="/wiki/Category:Cats?filefrom=Q">next page</a>'
    pages = [("https://h/wiki/Category:Cats", gallery + cats + more), ("https://h/wiki/Category:Cats?filefrom=Q", '<div class="gallerytext"><a href="/wiki/File:e.gif">x</a></div>'), ("https://h/wiki/Category:Teapots", '<div id="mw-content-text"><a href="/wiki/File:k.jpg">x</a></div>')]
    parsed = html.parse(spark.createDataFrame(pages, "url string, html string"), "https://h")
    rows = {r["url"].rpartition("/")[2]: r for r in parsed.collect()}
    assert rows["Category:Cats"]["files"] == ["https://h/wiki/File:a.jpg", "https://h/wiki/File:c%20d.PNG"]
    assert rows["Category:Cats"]["subcategories"] == ["Category:Teapots"] and rows["Category:Cats"]["next_page"] == "https://h/wiki/Category:Cats?filefrom=Q"
    starts = spark.createDataFrame([("Category:Cats", "https://h/wiki/Category:Cats"), ("Category:Teapots", "https://h/wiki/Category:Teapots")], "title string, url string")
    files = html.harvest(parsed, starts)
    assert {r["title"]: [f[-5:] for f in r["files"]] for r in files.collect()} == {"Category:Cats": ["a.jpg", "d.PNG", "e.gif"], "Category:Teapots": ["k.jpg"]}
    label = F.when(F.col("title") == "Category:Cats", "cat")
    cats = files.withColumn("class_label", label).withColumn("subcategories", F.when(label.isNotNull(), F.array(F.lit("Category:Teapots"))))
    got = html.candidate_pages(cats, 2).orderBy("rank").collect()
    assert [(r["class_label"], r["url"][-5:], r["rank"]) for r in got] == [("cat", "a.jpg", 1), ("cat", "d.PNG", 2), ("cat", "e.gif", 3), ("cat", "k.jpg", 4)]
    assert html.candidate_pages(cats, 1).count() == 2


ITEMS = [
    {"id": "1", "url": "u1", "license": "by", "license_version": "2.0", "creator": "me", "attribution": ""}, {"id": "2", "url": None, "license": "by"},
    {"id": "3", "url": "u3", "license": None}, {"url": "u4", "license": "cc0", "title": "é"}, {"id": "5", "url": "", "license": ""},
]


def test_api_records(spark):
    pages = spark.createDataFrame([("cat", json.dumps({"result_count": 5, "page_count": 1, "results": ITEMS})), ("cat", "no json"), ("dog", json.dumps({"results": []}))], "class_label string, page string").withColumn("fetched_at", F.current_timestamp())
    out = api.records(api.items(pages))
    got = {r["image_url"]: (r["license_raw"], r["source_id"], r["attribution"], r["title"]) for r in out.kept.collect()}
    assert got == {"u1": ("by-2.0", "1", "me", None), "u4": ("cc0", "u4", None, "é")}
    assert sorted(r["reason_code"] for r in out.rejections.collect()) == ["MISSING_IMAGE_URL", "MISSING_IMAGE_URL", "MISSING_LICENSE"]
    assert json.loads(out.kept.where("image_url = 'u1'").first()["payload"]) == ITEMS[0]
    limits = spark.createDataFrame([("cat", 1)], "class_label string, fetch_limit long")
    both = api.union_sources(out.kept, out.kept.withColumn("source", F.lit("wikimedia_commons")))
    assert api.per_class_limit(both, limits, ["source_id"]).count() == 2


# Bytes ----------------------------------------------------------------------------------------------------------------
def picture(w, h, seed=1):
    y, x = np.mgrid[0:h, 0:w] / max(w, h)
    r = np.random.default_rng(seed)
    waves = sum(np.sin(2 * np.pi * (a * x + b * y) + c) for a, b, c in r.uniform(-3, 3, (5, 3)))
    return ((waves - waves.min()) / (waves.max() - waves.min()) * 255).astype(np.uint8)


def png(pixels):
    h, w = pixels.shape
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    raw = b"".join(b"\x00" + row.tobytes() for row in pixels)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def jpeg(w, h, whole=True):
    return b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08" + struct.pack(">HH", h, w) + b"\x01\x01\x11\x00\xff\xda\x00\x02" + b"data" * 50 + (b"\xff\xd9" if whole else b"")


FILES = {
    "png": (png(picture(40, 30)), ("PNG", 40, 30, None)), "png cut": (png(picture(40, 30))[:-30], ("PNG", 40, 30, "truncated")), "jpeg": (jpeg(320, 240), ("JPEG", 320, 240, None)),
    "jpeg cut": (jpeg(320, 240, False), ("JPEG", 320, 240, "truncated")), "stub": (b"\xff\xd8\xff\xe0tiny", ("JPEG", None, None, "unreadable")), "html": (b"<html>", (None, None, None, "unreadable")),
    "gif": (b"GIF89a" + struct.pack("<HH", 5, 6) + b"...;", ("GIF", 5, 6, None)), "bmp": (b"BM" + struct.pack("<I", 60) + bytes(8) + struct.pack("<Iii", 40, 7, -8) + bytes(40), ("BMP", 7, 8, None)),
    "webp": (b"RIFF" + struct.pack("<I", 30) + b"WEBPVP8X" + bytes(8) + (99).to_bytes(3, "little") + (49).to_bytes(3, "little") + bytes(8), ("WEBP", 100, 50, None)),
    "tiff": (b"II*\x00" + struct.pack("<I", 8) + struct.pack("<H", 2) + struct.pack("<HHIHH", 256, 3, 1, 9, 0) + struct.pack("<HHII", 257, 4, 1, 11) + bytes(4), ("TIFF", 9, 11, None)), "none": (None, (None, None, None, "unreadable")),
}


def test_measures(spark):
    df = spark.createDataFrame([(k, b) for k, (b, _) in FILES.items()], "k string, content binary")
    got = {r["k"]: (r["format"], r["width"], r["height"], r["status"]) for r in images.with_measures(df).collect()}
    assert got == {k: w for k, (_, w) in FILES.items()}


def test_perceptual_hash():
    far = lambda a, b: (int(images.phash(a), 16) ^ int(images.phash(b), 16)).bit_count()
    a = picture(320, 240, 1)
    assert far(a, picture(160, 120, 1)) <= 5 and far(a, np.repeat(a[:, :, None], 3, 2)) <= 5
    assert far(a, np.clip(a.astype(int) + np.random.default_rng(0).integers(-6, 7, a.shape), 0, 255).astype(np.uint8)) <= 5
    assert far(a, picture(320, 240, 4)) > 5 and len(images.phash(picture(3, 2))) == 16


def test_assets_of_a_folder(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(picture(100, 80)))
    (tmp_path / "b.jpg").write_bytes(png(picture(50, 40)))
    (tmp_path / "c.png").write_bytes(FILES["png cut"][0])
    got = {r["storage_path"][-5:]: r for r in images.read_assets(spark, f"file://{tmp_path}").collect()}
    assert (got["a.png"]["width"], got["b.jpg"]["format"], got["c.png"]["status"], got["c.png"]["phash"]) == (100, "PNG", "truncated", None)
    assert (int(got["a.png"]["phash"], 16) ^ int(got["b.jpg"]["phash"], 16)).bit_count() <= 5


# Requests -------------------------------------------------------------------------------------------------------------
class Reply:
    def __init__(self, body=b"", kind="image/png"):
        self.body, self.headers = body, {"Content-Type": kind}

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False

    def read(self, n=-1):
        out, self.body = (self.body, b"") if n < 0 else (self.body[:n], self.body[n:])
        return out


def client(replies, **cfg):
    slept, asked, now = [], [], [0.0]

    def sleep(s):
        slept.append(s)
        now[0] += s

    def opener(request, timeout):
        asked.append(request.full_url)
        r = replies.pop(0)
        if isinstance(r, Exception):
            raise r
        return r

    return fetch.Client(Http(**cfg), sleep, lambda: now[0], opener), slept, asked


def status(code, after=None):
    return urllib.error.HTTPError("u", code, "m", {"Retry-After": after} if after else {}, None)


def test_retries_and_backoff():
    c, slept, asked = client([status(503), status(429, "9"), Reply(b"x")], min_delay=0)
    assert c.image("http://h/a")[0] == b"x" and len(asked) == 3
    assert 0.75 <= slept[0] < 2.25 and slept[1] == 9
    for replies, reason in (([status(404)], "HTTP_ERROR"), ([status(429)] * 4, "HTTP_ERROR"), ([OSError("x")] * 4, "HTTP_ERROR"), ([TimeoutError()] * 4, "TIMEOUT"), ([Reply(b"")], "EMPTY_RESPONSE"), ([Reply(b"x", "text/html")], "NOT_AN_IMAGE"), ([Reply(b"x" * 99)], "TOO_LARGE")):
        c, *_ = client(replies, max_bytes=50)
        with pytest.raises(fetch.Failed) as e:
            c.image("http://h/a")
        assert e.value.reason == reason and not replies


def test_throttle_by_host():
    c, slept, _ = client([Reply(b"x") for _ in range(4)], min_delay=0.5, host_delays={"slow": 2.0})
    for u in ("http://a/1", "http://b/1", "http://a/2", "http://slow/1"):
        c.text(u)
    assert slept == [0.5]
    c, slept, _ = client([Reply(b"x") for _ in range(2)], host_delays={"slow": 2.0})
    c.text("http://slow/1"), c.text("http://slow/2")
    assert slept == [2.0]


def test_robots():
    c, _, asked = client([Reply(b"User-agent: *\nDisallow: /no")])
    assert not c.allowed("http://h/no/x") and c.allowed("http://h/yes") and len(asked) == 1
    c, *_ = client([status(500)])
    assert c.allowed("http://h/no/x")
    assert client([], respect_robots=False)[0].allowed("http://h/no")


@pytest.fixture(scope="module")
def site():
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            if self.path.startswith("/api"):
                number = int(self.path.split("page=")[1].split("&")[0])
                body, kind = json.dumps({"page_count": 2, "results": [{"id": f"{number}-{k}", "url": f"u{number}{k}", "license": "by"} for k in range(3)]}).encode(), "application/json"
            elif self.path == "/a.png":
                body, kind = png(picture(80, 70)), "image/png"
            else:
                body, kind = b"<html>", "text/html"
            self.send_response(200)
            self.send_header("Content-Type", kind)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_download_stage(spark, site, tmp_path):
    rows = [("openverse", "cat", "1", f"{site}/a.png"), ("openverse", "cat", "2", f"{site}/b.png"), ("openverse", "dog", "3", f"{site}/a.png")]
    df = spark.createDataFrame(rows, "source string, class_label string, source_id string, image_url string")
    for _ in range(2):
        out = fetch.download(df, f"file://{tmp_path}/images", Http(min_delay=0))
        kept = out.kept.collect()
        assert sorted(r["source_id"] for r in kept) == ["1", "3"] and all(len(r["sha256"]) == 64 for r in kept)
        assert [(r["source_id"], r["reason_code"]) for r in out.rejections.collect()] == [("2", "NOT_AN_IMAGE")]
        files = [p for p in tmp_path.rglob("*") if p.is_file()]  # no staging is left
        assert [f"file://{p}" for p in files] == [kept[0]["storage_path"]] and files[0].stat().st_size == kept[0]["file_size_bytes"]
        assert fetch.existing_paths(out.kept.select("storage_path").union(spark.createDataFrame([("file:///nowhere/x",)], "storage_path string"))).count() == 1


def test_api_data_source(spark, site):
    spark.dataSource.register(api.ApiPages)
    df = spark.read.format("gleaner_api").option("url", f"{site}/api").option("classes", "cat,dog").option("limit", 9).option("delay", 0).load()
    assert df.groupBy("class_label").count().orderBy("class_label").collect() == [("cat", 2), ("dog", 2)]
    assert api.records(api.items(df.withColumn("fetched_at", F.current_timestamp()))).kept.count() == 12


def test_a_token_is_renewed_before_it_ends():
    def reply(n):
        return Reply(json.dumps({"access_token": f"t{n}", "expires_in": 100}).encode(), "application/json")

    c, _, asked = client([reply(1), reply(2), status(401), Reply(b"x")], min_delay=0, max_tries=1)
    lease = fetch.TokenLease(c, "http://h/token", "me", "secret")
    seen = []
    for wait in (0, 80, 20, 100, 10):
        c.sleep(wait)
        lease.renew()
        seen.append(c.headers.get("Authorization"))
    assert seen == ["Bearer t1", "Bearer t1", "Bearer t2", None, None] and len(asked) == 3
    fetch.TokenLease(c, "http://h/token", None, None).renew()
    assert len(asked) == 3
