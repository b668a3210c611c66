"""A crawl and whole runs against a local site."""

import http.server
import json
import threading
import urllib.parse
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleaner import cli
from gleaner.config import Http, load
from gleaner.plans.pipeline import Runner
from gleaner.plans.store import Store
from gleaner.sources.crawl import Crawl
from tests.test_sources import CC, page, picture, png


class Site:
    """listings: title to pages, each a list of file names; below: title to subcategories; bare: files whose page has no licence."""

    def __init__(self):
        self.listings, self.below, self.bare, self.results = {}, {}, set(), {}
        self.asked: Counter = Counter()

    def listing(self, title, number):
        files = self.listings.get(title, [[]])
        links = "".join(f'<li class="gallerybox"><a href="/wiki/File:{f}">x</a></li>' for f in files[number])
        more = f'<a href="/wiki/{title}?filefrom={number + 1}">next page</a>' if number + 1 < len(files) else ""
        below = "".join(f'<a href="/wiki/{t}">{t}</a>' for t in self.below.get(title, []))
        return f'<html><body><ul id="mw-category-media">{links}</ul><div id="mw-subcategories">{below}</div>{more}</body></html>'

    def reply(self, path):
        self.asked[path] += 1
        url = urllib.parse.urlsplit(path)
        query = dict(urllib.parse.parse_qsl(url.query))
        name = urllib.parse.unquote(url.path.rpartition("/")[2])
        if url.path == "/robots.txt":
            return "User-agent: *\nDisallow: /wiki/File:secret", "text/plain"
        if url.path == "/api/images/":
            found = self.results.get(query["q"], [])
            size, number = int(query["page_size"]), int(query["page"])
            return json.dumps({"page_count": -(-len(found) // size), "results": found[(number - 1) * size : number * size]}), "application/json"
        if name.startswith("File:"):
            link = f'<div class="fullImageLink"><a href="{self.url}/img/{name[5:]}">full</a></div>'
            return page("" if name[5:] in self.bare else CC.format("by/2.0"), link=link), "text/html"
        if name.startswith("Category:"):
            return self.listing(name, int(query.get("filefrom", 0))), "text/html"
        if url.path.startswith("/img/"):
            return png(picture(120, 90, sum(name.encode()) * 7919 + len(name))) + bytes(1500), "image/png"
        return None


@pytest.fixture
def site():
    made = Site()

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            got = made.reply(self.path)
            self.send_response(404 if got is None else 200)
            body = (got or ("", ""))[0]
            self.send_header("Content-Type", (got or ("", "text/html"))[1])
            self.end_headers()
            self.wfile.write(body if isinstance(body, bytes) else body.encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    made.url = f"http://127.0.0.1:{server.server_port}"
    yield made
    server.shutdown()


def names(df):
    return {c: [r["u"] for r in sorted(rows, key=lambda r: r["rank"])] for c, rows in _grouped(df.withColumn("u", F.substring_index("url", ":", -1)).collect()).items()}


def _grouped(rows):
    out: dict = {}
    for r in rows:
        out.setdefault(r["class_label"], []).append(r)
    return out


def crawl(spark, site, classes, **source):
    cfg = load({}, source__site_url=site.url, **{f"source__{k}": v for k, v in source.items()}).source
    return Crawl(spark.createDataFrame(classes, "class_label string, title string, cap long"), cfg, Http(min_delay=0), 3)


def plain_files(site, title, cap, pages=3, most=8):
    """One category after another, as a single client would go."""
    got: list = []
    for t in [title, *site.below.get(title, [])[:most]]:
        for listing in site.listings.get(t, [[]])[:pages]:
            if len(got) < 2 * cap:
                got += [f for f in dict.fromkeys(listing) if f not in got]
    return got[: 2 * cap]


def test_files_are_ranked_as_one_client_would_meet_them(spark, site):
    site.listings = {
        "Category:Kettles": [["k1.jpg", "k2.jpg"], ["k2.jpg", "k3.png"], ["k4.jpg"], ["k5.jpg"]], "Category:Red_kettles": [["r1.jpg", "k1.jpg"], ["r2.jpg"]], "Category:Blue_kettles": [["b1.jpg"]],
        "Category:Old_kettles": [["o1.jpg"]], "Category:Spoons": [[f"s{k}.jpg" for k in range(9)]], "Category:Big_spoons": [["never.jpg"]],
    }
    site.below = {"Category:Kettles": ["Category:Red_kettles", "Category:Blue_kettles", "Category:Old_kettles"], "Category:Spoons": ["Category:Big_spoons"]}
    for cap in (3, 10):
        site.asked.clear()
        c = crawl(spark, site, [("kettle", "Category:Kettles", cap), ("spoon", "Category:Spoons", 4), ("pot", None, 4), ("red", "Category:Red_kettles", 2)])
        got = names(c.file_pages())
        assert got == {"kettle": plain_files(site, "Category:Kettles", cap), "spoon": [f"s{k}.jpg" for k in range(8)], "red": ["r1.jpg", "k1.jpg", "r2.jpg"]}
        assert max(n for path, n in site.asked.items() if path != "/robots.txt") == 1
        assert "/wiki/Category:Big_spoons" not in site.asked


def test_records_fill_up_to_the_cap(spark, site):
    site.listings = {"Category:Kettles": [[f"k{k}.jpg" for k in range(12)]], "Category:Pans": [["k1.jpg", "secret.jpg", "p.jpg"]]}
    site.bare = {"k0.jpg", "k2.jpg", "k9.jpg"}
    c = crawl(spark, site, [("kettle", "Category:Kettles", 5), ("pan", "Category:Pans", 5)])
    out = c.records()
    kept = {(r["class_label"], r["title"]) for r in out.kept.collect()}
    assert kept == {("kettle", f"k{k}.jpg") for k in (1, 3, 4, 5, 6)} | {("pan", "k1.jpg"), ("pan", "p.jpg")}
    assert {(r["class_label"], r["source_id"].rpartition(":")[2], r["reason_code"]) for r in out.rejections.collect()} == {("kettle", f"k{k}.jpg", "MISSING_LICENSE") for k in (0, 2)}
    assert not any("secret" in p for p in site.asked) and site.asked["/wiki/File:k1.jpg"] == 1
    assert [t["round"] for t in c.trace][:1] == ["categories, page 1"]


def test_a_run_from_the_sources(spark, site, tmp_path, monkeypatch):
    site.listings = {"Category:Kettles": [[f"k{k}.png" for k in range(6)]]}
    site.results = {
        "kettle": [{"id": f"a{k}", "url": f"{site.url}/img/a{k}.png", "license": "by", "license_version": "4.0", "creator": "me"} for k in range(9)],
        "pan": [{"id": f"q{k}", "url": f"{site.url}/img/q{k}.png", "license": "cc0"} for k in range(4)] + [{"id": "gone", "url": f"{site.url}/gone.png", "license": "cc0"}, {"id": "x", "license": "by"}],
    }
    env = {"SOURCE_CLASSES": "kettle, pan", "SOURCE_TARGET": "4", "SOURCE_MINIMUM": "2", "SOURCE_API_URL": f"{site.url}/api", "SOURCE_SITE_URL": site.url, "SOURCE_CATEGORIES": json.dumps({"kettle": "Category:Kettles"}), "SOURCE_PAGE_SIZE": "4", "HTTP_MIN_DELAY": "0", "HTTP_MAX_TRIES": "1", "DEDUPE_MAX_DISTANCE": "0"}
    for k, v in env.items():
        monkeypatch.setenv(f"GLEANER_{k}", v)
    args = ["--store", f"file://{tmp_path}/store", "run", "--data", f"{tmp_path}/data", "--output", f"file://{tmp_path}/out", "--tree", f"{tmp_path}/tree"]
    assert cli.main(args) == 0
    store = Store(spark, f"file://{tmp_path}/store")
    raw = store.read("raw_records").groupBy("source", "class_label").count().collect()
    assert {tuple(r) for r in raw} == {("openverse", "kettle", 6), ("openverse", "pan", 5), ("wikimedia_commons", "kettle", 6)}  # 1.5 times the gap, and what is there
    metrics = {(r["stage"], r["metric"]): r["value"] for r in store.read("run_stage_metrics").collect()}
    assert metrics["download", "failed"] == 1 and metrics["download", "downloaded"] == 16 and metrics["select", "trimmed_over_target"] >= 4
    rows = store.read("images").collect()
    assert Counter(r["class_label"] for r in rows) == {"kettle": 4, "pan": 4}
    assert len([p for p in (tmp_path / "data" / "images").rglob("*.png")]) == 16 and not list((tmp_path / "data").rglob("*_staging/*"))
    assert len(list((tmp_path / "tree" / "images").rglob("*.png"))) == 8
    before = dict(site.asked)
    assert cli.main(args) == 0 and site.asked == before  # classes are full: no request at all
    assert {r["reason_code"] for r in store.read("rejections").collect()} >= {"HTTP_ERROR", "MISSING_IMAGE_URL", "OVER_TARGET"}
    cfg = load({f"GLEANER_{k}": v for k, v in env.items()}, data_dir=f"{tmp_path}/data", source__target=5)
    more = Runner(spark, store, cfg).execute(None, None, f"file://{tmp_path}/out")
    assert more.metrics["download"]["reused_from_store"] > 0 and Counter(r["class_label"] for r in store.read("images").collect())["kettle"] == 5


def test_trace(spark, site, monkeypatch, capsys):
    site.listings = {"Category:Kettles": [["k1.jpg"]]}
    for k, v in {"SOURCE_SITE_URL": site.url, "SOURCE_CATEGORIES": json.dumps({"kettle": "Category:Kettles"}), "HTTP_MIN_DELAY": "0"}.items():
        monkeypatch.setenv(f"GLEANER_{k}", v)
    assert cli.main(["trace", "--class-label", "kettle"]) == 0 and "categories, page 1" in capsys.readouterr().out
    assert cli.main(["trace", "--class-label", "lamp"]) == 1
