"""What a run asks of its sources: each class's gap, from the API and from the site."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.config import Settings
from gleaner.operators.stage import StageResult
from gleaner.plans.storage import materialize
from gleaner.schemas import CANDIDATE, columns
from gleaner.sources import api
from gleaner.sources.crawl import crawled

#: Credentials of the API's client; no setting, so that no snapshot holds them.
CLIENT_ID, CLIENT_SECRET = "GLEANER_API_CLIENT_ID", "GLEANER_API_CLIENT_SECRET"


def from_sources(gap: DataFrame, cfg: Settings) -> StageResult:
    """gap: class_label and fetch_limit, a row a class. Candidates of all sources, no more for a class and source than its limit, in the order in which each source gave them."""
    spark, source = gap.sparkSession, cfg.source
    limits = {r["class_label"]: r["fetch_limit"] for r in gap.where("fetch_limit > 0").collect()}
    if not limits:
        none = spark.createDataFrame([], CANDIDATE)
        return StageResult(none, spark.createDataFrame([], "stage string, source string, class_label string, source_id string, source_url string, reason_code string, detail string"))
    spark.dataSource.register(api.ApiPages)
    base = source.api_url.rstrip("/")
    options = {"url": f"{base}/images/", "token_url": f"{base}/auth_tokens/token/", "limits": json.dumps(limits), "page_size": source.page_size, "license_type": source.license_type, "delay": cfg.http.min_delay}
    options |= {o: os.environ[e] for o, e in (("client_id", CLIENT_ID), ("client_secret", CLIENT_SECRET)) if os.environ.get(e)}
    pages = spark.read.format("gleaner_api").options(**options).load()
    order = F.monotonically_increasing_id()  # one partition reads in turn, so this is the order of results
    pages = materialize(pages.select("class_label", "page", F.current_timestamp().alias("fetched_at"), order.alias("turn")), "api-pages")
    found = api.records(api.items(pages, ["turn"]), ["turn", "at"])
    listed = api.per_class_limit(found.kept, gap, ["turn", "at"]).select(columns(CANDIDATE))
    titles = F.create_map(*[F.lit(x) for c, t in source.categories.items() for x in (c, t)]) if source.categories else F.lit(None)
    budgets = gap.where("fetch_limit > 0").select("class_label", F.try_element_at(titles, "class_label").alias("title") if source.categories else F.lit(None).cast("string").alias("title"), F.least("fetch_limit", F.lit(source.scrape_cap)).alias("cap"))
    scraped = crawled(budgets, source, cfg.http, cfg.workers)
    kept = materialize(api.union_sources(listed, scraped.kept.select(columns(CANDIDATE))).drop("source_order"), "candidates")
    return StageResult(kept, materialize(found.rejections.unionByName(scraped.rejections), "ingest-rejections"))
