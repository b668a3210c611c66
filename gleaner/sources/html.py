"""Pages to records: a small tolerant tree on the standard parser, and what is read from it.

Trees are walked in Arrow-batched functions; everything after that (reasons, titles, caps) is column expressions.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import unquote, urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.functions import licenses, scalars
from gleaner.operators.stage import StageResult, route

# Where things stand on a page, most specific first.
CHROME = ["#footer", ".mw-footer", "#footer-info", ".printfooter", "#mw-navigation", "#siteNotice", "#catlinks"]
SCOPES = [
    "#mw-content-text .licensetpl", "#mw-content-text table.layouttemplate", "#mw-content-text .license", ".licensetpl",
    "table.layouttemplate", ".license", "#mw-imagepage-content", "#mw-content-text", "body",
]
SHORT_NAMES = ["span.licensetpl_short", ".licensetpl_short", "#licensetpl_short"]
GALLERIES = ["#mw-category-media li.gallerybox", "li.gallerybox", ".gallerytext"]
AUTHOR_LABEL = re.compile(r"^\s*(author|artist|photographer|creator|autor)\b", re.I)
PUBLIC_PROSE = re.compile(r"(?i:\bpublic domain\b)|\bCC0\b|(?i:\bpublicdomain\b)")
SKIPPED_CATEGORIES = ["by_country", "by_date", "Media_", "_by_year", "Categories_"]
VOID = set("area base br col embed hr img input link meta source track wbr".split())


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag, attrs=(), parent=None):
        self.tag, self.attrs, self.parent, self.children = tag, dict(attrs), parent, []

    def walk(self):
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self, joint: str = " ") -> str:
        parts, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                parts.append(x.strip())
            else:
                stack.extend(reversed(x.children))
        return joint.join(p for p in parts if p)

    def fits(self, simple: str) -> bool:
        tag, id_, class_, attr, op, value = re.fullmatch(r"([\w-]*)(?:#([\w-]+))?(?:\.([\w-]+))?(?:\[(\w+)(?:([\^*])=\"([^\"]*)\")?\])?", simple).groups()
        if (tag and tag != self.tag) or (id_ and self.attrs.get("id") != id_):
            return False
        if class_ and class_ not in (self.attrs.get("class") or "").split():
            return False
        if attr:
            held = self.attrs.get(attr)
            return held is not None and (op is None or (held.startswith(value) if op == "^" else value in held))
        return True

    def select(self, selector: str) -> list[Node]:
        """Descendants that fit a chain of simple selectors (tag, #id, .class, [attr^="x"], [attr*="x"])."""
        *above, last = selector.split(" ")
        out = []
        for node in self.walk():
            if node is not self and node.fits(last):
                want, up = list(above), node.parent
                while want and up is not None:
                    if up.fits(want[-1]):
                        want.pop()
                    up = up.parent
                if not want:
                    out.append(node)
        return out

    def first(self, selector: str) -> Node | None:
        return next(iter(self.select(selector)), None)

    def next_cell(self) -> Node | None:
        """The next td beside this node."""
        beside = [c for c in self.parent.children if isinstance(c, Node)] if self.parent else []
        return next((c for c in beside[beside.index(self) + 1 :] if c.tag == "td"), None) if beside else None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")

    def handle_starttag(self, tag, attrs):
        if tag in ("li", "tr", "td", "th", "p", "option") and self.at.tag == tag:  # end tags that pages leave out
            self.at = self.at.parent or self.root
        node = Node(tag, attrs, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, attrs, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.at = node.parent

    def handle_data(self, data):
        if self.at.tag not in ("script", "style"):
            self.at.children.append(data)


def tree(html: str | None) -> Node:
    """The page without its chrome: site furniture must never answer for an asset."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    for selector in CHROME:
        for node in builder.root.select(selector):
            if node.parent is not None and node in node.parent.children:
                node.parent.children.remove(node)
    return builder.root


def _absolute(href: str | None) -> str | None:
    return f"https:{href}" if href and href.startswith("//") else href


def licence_boxes(root: Node) -> list[tuple[str, str, str | None]]:
    """(kind, text or deed, deed URL) of each box of the first scope that stands on the page; kind is deed, name or prose."""
    nodes = next((found for s in SCOPES if (found := root.select(s))), [])
    out = []
    for box in nodes:
        deeds = [a.attrs.get("href") or "" for a in box.select('a[href*="creativecommons.org"]')]
        deed = next((d for d in deeds if re.search(r"creativecommons\.org/(licenses/[a-z-]+|publicdomain/(zero|mark))", d, re.I)), None)
        name = next((n.text("") for s in SHORT_NAMES if (n := box.first(s)) is not None and n.text("")), None)
        link = _absolute(deeds[0]) if deeds else None
        if deed:
            out.append(("deed", deed, _absolute(deed)))
        elif name:
            out.append(("name", name, link))
        elif PUBLIC_PROSE.search(box.text()):
            out.append(("prose", "Public domain", link))
    return out


def file_page(html: str | None) -> dict:
    """image, preview, boxes, author: what a file's page says, uninterpreted; error if it can't be read."""
    try:
        root = tree(html)
        link = root.first(".fullImageLink a[href]")
        shown = root.first("#file img[src]") or root.first(".fullMedia img[src]")
        cell = root.first("#fileinfotpl_aut")
        cell = cell.next_cell() if cell is not None else None
        if cell is None:
            labels = [n for n in root.walk() if n.fits("td.fileinfo-paramfield") or n.fits("th.fileinfo-paramfield")]
            cell = next((n.next_cell() for n in labels if AUTHOR_LABEL.match(n.text())), None)
        boxes = [{"kind": k, "text": t, "url": u} for k, t, u in licence_boxes(root)]
        return {"image": link.attrs["href"] if link else None, "preview": shown.attrs["src"] if shown else None, "boxes": boxes, "author": cell.text() if cell else None, "error": None}
    except Exception as e:  # pages are hostile input: one bad page is one rejection
        return {"image": None, "preview": None, "boxes": [], "author": None, "error": f"{type(e).__name__}: {e}"}


PAGE = "image string, preview string, boxes array<struct<kind:string,text:string,url:string>>, author string, error string"


def file_links(root: Node) -> list[str]:
    for selector in GALLERIES:
        found = [a.attrs.get("href") for box in root.select(selector) if (a := box.first('a[href^="/wiki/File:"]')) is not None]
        if found:
            return found
    content = root.first("#mw-content-text") or root
    return [a.attrs["href"] for a in content.select('a[href^="/wiki/File:"]')]


def subcategories(root: Node, own: str) -> list[str]:
    box = root.first("#mw-subcategories") or root.first("#mw-content-text")
    found = [] if box is None else [unquote(a.attrs["href"].split("/wiki/", 1)[-1]).split("#")[0] for a in box.select('a[href^="/wiki/Category:"]')]
    return list(dict.fromkeys(t for t in found if t.startswith("Category:") and t != own and not any(m in t for m in SKIPPED_CATEGORIES)))


def category_page(html: str | None, url: str, base: str) -> dict:
    root = tree(html)
    suffix = re.compile(rf"\.({'|'.join(scalars.IMAGE_SUFFIXES)})$")
    files = [urljoin(base, h) for h in file_links(root)]
    files = list(dict.fromkeys(f for f in files if suffix.search(unquote(f).split("?")[0].lower())))
    more = next((urljoin(base, a.attrs["href"]) for a in root.select('a[href*="filefrom="]') if "next page" in a.text().lower()), None)
    return {"files": files, "subcategories": subcategories(root, unquote((url or "").split("/wiki/", 1)[-1])), "next_page": more}


CATEGORY = "files array<string>, subcategories array<string>, next_page string"


def parse(pages: DataFrame, base: str | None = None) -> DataFrame:
    """pages: url, html. With the fields of file pages, or (given base, the site's URL) of category pages."""

    def run(batches):
        for pdf in batches:
            rows = [category_page(h, u, base) if base else file_page(h) for u, h in zip(pdf["url"], pdf["html"], strict=True)]
            yield pd.concat([pdf.drop(columns=["html"]).reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    fields = CATEGORY if base else PAGE
    names = [f.split()[0] for f in re.split(r", (?=\w+ )", fields)]
    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != "html")
    return pages.mapInPandas(run, f"{rest}, {fields}")


def scraped_records(pages: DataFrame, class_label: Column | None = None) -> StageResult:
    """pages: url, html, class_label, fetched_at. Candidate records; pages without an image or a licence are rejected, parse errors first."""
    df = parse(pages)
    box = F.transform("boxes", lambda b: F.struct(F.when(b["kind"] == "deed", licenses.deed_license(b["text"])).otherwise(b["text"]).alias("licence"), b["url"].alias("url")))
    ranked = F.transform(box, lambda b, i: F.struct(licenses.restrictiveness(b["licence"]).alias("rank"), (-i).alias("at"), b["licence"].alias("licence"), b["url"].alias("url")))
    df = df.withColumn("_best", F.array_max(ranked))  # the most restrictive box, the first of equals
    df = df.withColumn("image_url", F.coalesce(scalars.absolute(F.col("image")), scalars.original_url(F.col("preview"))))
    df = df.withColumns({"license_raw": scalars.present(F.col("_best.licence")), "license_url": F.col("_best.url"), "attribution": scalars.credit_line(F.col("author")), "title": scalars.title_of(F.col("url"))})
    df = df.withColumns({"source": F.lit("wikimedia_commons"), "source_id": F.col("url"), "landing_url": F.col("url")})
    df = df.withColumn("payload", F.to_json(F.struct(F.col("url").alias("file_page"), "image_url", "license_raw", "title", F.lit("html").alias("scraped_from"))))
    reason = F.when(F.col("error").isNotNull(), "PARSE_ERROR").when(scalars.present(F.col("image_url")).isNull(), "MISSING_IMAGE_URL").when(F.col("license_raw").isNull(), "MISSING_LICENSE")
    out = route(df, "ingest", reason, F.col("error"))
    kept = out.kept.select("source", "class_label", "image_url", "source_id", "landing_url", "license_raw", "license_url", "attribution", "title", "payload", "fetched_at")
    return StageResult(kept, out.rejections)


def candidate_pages(categories: DataFrame, cap: int, max_subcategories: int = 8, use_subcategories: bool = True) -> DataFrame:
    """categories: class_label, title, files, subcategories (parsed). File URLs a class takes: direct ones first, then those of its first subcategories, 2 * cap at most, each once."""
    top = categories.where("class_label is not null")
    direct = top.select("class_label", F.lit(0).alias("depth"), F.lit(0).alias("branch"), F.posexplode("files").alias("at", "url"))
    below = top.select("class_label", F.posexplode(F.slice("subcategories", 1, max_subcategories)).alias("branch", "title"))
    below = below.join(categories.select("title", "files"), "title").select("class_label", F.lit(1).alias("depth"), "branch", F.posexplode("files").alias("at", "url"))
    every = direct.unionByName(below) if use_subcategories else direct
    first = every.groupBy("class_label", "url").agg(F.min(F.struct("depth", "branch", "at")).alias("place"))
    rank = F.row_number().over(W.partitionBy("class_label").orderBy("place"))
    return first.withColumn("rank", rank).where(F.col("rank") <= 2 * cap).select("class_label", "url", "rank")


def harvest(pages: DataFrame, starts: DataFrame, max_pages: int = 3) -> DataFrame:
    """pages: url, files, next_page (parsed); starts: title, url. Files over up to max_pages pages of each category, in order, each once."""
    at = starts.select("title", "url", F.lit(0).alias("page"))
    seen = at
    for k in range(1, max_pages):
        at = at.join(pages.select("url", "next_page"), "url").where("next_page is not null").select("title", F.col("next_page").alias("url"), F.lit(k).alias("page"))
        seen = seen.unionByName(at)
    links = seen.join(pages.select("url", "files"), "url").select("title", "page", F.posexplode("files").alias("at", "file"))
    first = links.groupBy("title", "file").agg(F.min(F.struct("page", "at")).alias("place"))
    return first.groupBy("title").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "file"))), lambda x: x["file"]).alias("files"))
