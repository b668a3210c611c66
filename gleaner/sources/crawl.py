"""Category pages and file pages of a site, in rounds of a frontier with a visited set and a budget for each class.

A round asks for the pages that some class still needs and that no round has asked for, each once whichever classes need
it, and parses them where they are fetched; only links go on. Listings come first: of each class's category, up to
max_pages pages; then, for classes that are short of twice their cap, those of its first subcategories, and of these
only the ones that the files of earlier branches leave a need for. Then file pages by rank until a class has its cap of
records, twice as many pages a round as are missing. So there are 2 * max_pages rounds of listings at most, and a number of
rounds of file pages that grows with the logarithm of the cap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.config import Http, Source
from gleaner.operators.stage import StageResult
from gleaner.plans.storage import materialize
from gleaner.sources import html
from gleaner.sources.http import fetched_pages

_LISTING = "url string, files array<string>, subcategories array<string>, next_page string"


class Crawl:
    """budgets: class_label, title (of its category) and cap (records), a row a class."""

    def __init__(self, budgets: DataFrame, cfg: Source = Source(), http: Http = Http(), tasks: int = 8):
        self.spark, self.cfg, self.http, self.tasks = budgets.sparkSession, cfg, http, tasks
        self.budgets = materialize(budgets.where("title is not null and cap > 0").select("class_label", "title", "cap"), "budgets")
        self.listings = self.spark.createDataFrame([], _LISTING)
        self.trace: list[dict] = []

    def _url(self, title):
        return F.concat(F.lit(f"{self.cfg.site_url.rstrip('/')}/wiki/"), title)

    def _visit(self, what: str, urls: DataFrame) -> bool:
        """Fetch listings that are not there yet; whether there were any."""
        new = materialize(urls.where("url is not null").select("url").distinct().join(self.listings.select("url"), "url", "left_anti"), "frontier")
        asked = new.count()
        if asked:
            pages = fetched_pages(new, self.http, self.tasks)
            parsed = materialize(html.parse(pages, self.cfg.site_url).select("url", "files", "subcategories", "next_page"), "listings")
            self.listings = self.listings.unionByName(parsed)
            self.trace.append({"round": what, "asked": asked, "files": parsed.agg(F.sum(F.size("files"))).first()[0] or 0})
        return asked > 0

    def _branches(self) -> DataFrame:
        """class_label, cap, branch (0 is the category itself, then its subcategories in order), title and url of what a class may list."""
        top = self.budgets.select("class_label", "cap", F.lit(0).alias("branch"), "title", self._url(F.col("title")).alias("url"))
        below = top.join(self.listings.select("url", "subcategories"), "url").select("class_label", "cap", F.posexplode(F.slice("subcategories", 1, self.cfg.max_subcategories)).alias("branch", "title"))
        return top.unionByName(below.select("class_label", "cap", (F.col("branch") + 1).alias("branch"), "title", self._url(F.col("title")).alias("url")))

    def _listed(self, branches: DataFrame) -> DataFrame:
        """branches with page, the number of a listing, and its url, as far as pages are known."""
        at = branches.withColumn("page", F.lit(0))
        seen = at
        for k in range(1, self.cfg.max_pages):
            at = at.join(self.listings.select("url", "next_page"), "url").where("next_page is not null")
            at = at.select("class_label", "cap", "branch", "title", F.col("next_page").alias("url"), F.lit(k).alias("page"))
            seen = seen.unionByName(at)
        return seen

    def _short(self, branches: DataFrame) -> DataFrame:
        """class_label and branch of the branches that the files of this and earlier ones leave short of the budget."""
        files = self._listed(branches).join(self.listings.select("url", "files"), "url").select("class_label", "branch", F.explode("files").alias("file"))
        first = files.groupBy("class_label", "file").agg(F.min("branch").alias("branch")).groupBy("class_label", "branch").agg(F.count("*").alias("n"))
        upto = W.partitionBy("class_label").orderBy("branch")  # a class has max_subcategories branches at most
        known = branches.select("class_label", "cap", "branch").join(first, ["class_label", "branch"], "left")
        return known.withColumn("n", F.coalesce(F.sum("n").over(upto), F.lit(0))).where(F.col("n") < 2 * F.col("cap")).select("class_label", "branch")

    def file_pages(self) -> DataFrame:
        """class_label, cap, url and rank of the file pages of each class, 2 * cap at most, each once."""
        for depth in (0, 1):
            if depth and not self.cfg.subcategories:
                break
            for page in range(self.cfg.max_pages):
                branches = self._branches().where(F.col("branch") == 0 if depth == 0 else F.col("branch") > 0)
                every = self._branches() if depth else branches
                # A branch that earlier ones have filled up is not opened; one that still falls short goes to its next page.
                short = self._short(every)
                before = short.select("class_label", (F.col("branch") + 1).alias("branch"))
                wanted = branches.join(before if page == 0 and depth else short, ["class_label", "branch"], "left_semi")
                urls = self._listed(wanted).where(F.col("page") == page)
                if not self._visit(f"{'subcategories' if depth else 'categories'}, page {page + 1}", urls.select("url")):
                    break
        places = self._listed(self._branches()).join(self.listings.select("url", "files"), "url")
        places = places.select("class_label", "cap", "branch", "page", F.posexplode("files").alias("at", "url"))
        first = places.groupBy("class_label", "cap", "url").agg(F.min(F.struct("branch", "page", "at")).alias("place"))
        rank = F.row_number().over(W.partitionBy("class_label").orderBy("place"))
        return first.withColumn("rank", rank).where(F.col("rank") <= 2 * F.col("cap")).select("class_label", "cap", "url", "rank")

    def records(self) -> StageResult:
        """Candidate records of each class, its cap at most, and rejections of the pages before its last."""
        ranked = materialize(self.file_pages(), "ranked")
        fetched = self.spark.createDataFrame([], "url string, html string")
        asked = ranked.limit(0)
        while True:
            pages = asked.join(fetched.where("html is not null"), "url").withColumn("fetched_at", F.current_timestamp())
            found = html.scraped_records(pages)
            kept = found.kept.join(ranked.select("class_label", F.col("url").alias("source_id"), "rank"), ["class_label", "source_id"])
            n = kept.groupBy("class_label").agg(F.count("*").alias("n"))
            state = self.budgets.select("class_label", "cap").join(n, "class_label", "left").select("class_label", (F.col("cap") - F.coalesce("n", F.lit(0))).alias("missing"))
            rest = ranked.join(asked.select("class_label", "url"), ["class_label", "url"], "left_anti").join(state.where("missing > 0"), "class_label")
            nth = F.row_number().over(W.partitionBy("class_label").orderBy("rank"))
            more = rest.withColumn("_nth", nth).where(F.col("_nth") <= 2 * F.col("missing")).select("class_label", "cap", "url", "rank")
            more = materialize(more, "asked")
            if more.isEmpty():
                break
            new = materialize(more.select("url").distinct().join(fetched.select("url"), "url", "left_anti"), "frontier")
            fetched = fetched.unionByName(materialize(fetched_pages(new, self.http, self.tasks), "pages"))
            asked = asked.unionByName(more)
            self.trace.append({"round": "file pages", "asked": new.count()})
        nth = F.row_number().over(W.partitionBy("class_label").orderBy("rank"))
        taken = materialize(kept.withColumn("_nth", nth).join(self.budgets.select("class_label", "cap"), "class_label").where("_nth <= cap"), "taken")
        last = taken.where("_nth = cap").select("class_label", F.col("rank").alias("last"))
        lost = found.rejections.join(ranked.select("class_label", F.col("url").alias("source_id"), "rank"), ["class_label", "source_id"]).join(last, "class_label", "left")
        lost = lost.where(F.col("last").isNull() | (F.col("rank") < F.col("last"))).select(found.rejections.columns)
        return StageResult(taken.select(found.kept.columns), lost)


def crawled(budgets: DataFrame, cfg: Source = Source(), http: Http = Http(), tasks: int = 8) -> StageResult:
    return Crawl(budgets, cfg, http, tasks).records()
