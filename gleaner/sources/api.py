"""Landed pages of the JSON API to candidate records, and a data source that fetches such pages."""

from __future__ import annotations

import json
import urllib.parse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gleaner.functions.scalars import present
from gleaner.operators.stage import StageResult, route


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """class_label and page (text) of landed JSON lines."""
    return spark.read.schema("class_label string, page string, fetched_at timestamp").json(path)


def items(pages: DataFrame, more: list[str] | None = None) -> DataFrame:
    """A row for each result of each page, its JSON kept whole as payload; more: other columns of pages to keep."""
    results = F.from_json(F.get_json_object("page", "$.results"), "array<string>")
    return pages.select("class_label", "fetched_at", *(more or []), F.posexplode(results).alias("at", "payload"))


def field(name: str, payload: Column | None = None) -> Column:
    """A string field of the payload through the variant type; null where it is absent or no JSON."""
    source = F.col("payload") if payload is None else payload
    return F.try_variant_get(F.try_parse_json(source), f"$.{name}", "string")


def records(items_: DataFrame, more: list[str] | None = None) -> StageResult:
    """Candidates: a missing URL is checked first, then a missing licence; empty strings are missing. more: other columns to keep."""
    get = lambda n: present(field(n))
    df = items_.select(
        F.lit("openverse").alias("source"), "class_label", field("url").alias("image_url"), F.coalesce(get("id"), get("url")).alias("source_id"),
        field("foreign_landing_url").alias("landing_url"), F.when(get("license").isNotNull(), F.concat_ws("-", get("license"), get("license_version"))).alias("license_raw"),
        field("license_url").alias("license_url"), F.coalesce(get("attribution"), get("creator")).alias("attribution"), field("title").alias("title"), "payload", "fetched_at", *(more or []),
    )
    return route(df, "ingest", F.when(present(F.col("image_url")).isNull(), "MISSING_IMAGE_URL").when(F.col("license_raw").isNull(), "MISSING_LICENSE"))


def per_class_limit(candidates: DataFrame, limits: DataFrame, order: list[str]) -> DataFrame:
    """The first fetch_limit candidates of each class and source; limits: class_label, fetch_limit, a row a class."""
    most = limits.agg(F.max("fetch_limit")).first()[0] or 0
    rank = F.row_number().over(W.partitionBy("class_label", "source").orderBy(*order))
    df = candidates.withColumn("_rank", rank).where(F.col("_rank") <= int(most))  # a fixed bound: tasks cut before the shuffle
    df = df.join(F.broadcast(limits.select("class_label", "fetch_limit")), "class_label")
    return df.where("_rank <= fetch_limit").drop("_rank", "fetch_limit")


def union_sources(*frames: DataFrame) -> DataFrame:
    """All sources in their registered order, which breaks ties later."""
    out = [f.withColumn("source_order", F.lit(k)) for k, f in enumerate(frames)]
    first, *rest = out
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first


class ApiPages(DataSource):
    """spark.read.format("gleaner_api").option("url", ...).option("limits", '{"cat": 90}').load(): class_label and page.

    limits: JSON of how many results each class may bring; classes with none are not asked for (classes and limit give all
    the same). One partition reads all classes of the host, one after another, so that the host's delay holds over them;
    pages of a class are asked for in turn until its limit, an empty page, the last page or an error. client_id and
    client_secret are exchanged for a token at token_url; without them, or if that fails, requests are anonymous.
    """

    @classmethod
    def name(cls) -> str:
        return "gleaner_api"

    def schema(self) -> str:
        return "class_label string, page string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[InputPartition]:
        given = self.options.get("limits")
        same = int(self.options.get("limit", 20))
        limits = json.loads(given) if given else {c.strip(): same for c in self.options["classes"].split(",")}
        return [InputPartition([(c, int(n)) for c, n in limits.items() if int(n) > 0])]

    def read(self, partition: InputPartition):
        from gleaner.config import Http
        from gleaner.sources.http import Client, Failed, TokenLease

        get = self.options.get
        client = Client(Http(min_delay=float(get("delay", 0.5))))
        lease = TokenLease(client, get("token_url", ""), get("client_id"), get("client_secret"))
        size = int(get("page_size", 20))
        for label, limit in partition.value:
            got, page = 0, 1
            while got < limit:
                query = {"q": label, "page": page, "page_size": size, "license_type": get("license_type", "commercial,modification"), "category": "photograph", "mature": "false"}
                try:
                    lease.renew()
                    text = client.text(f"{self.options['url']}?{urllib.parse.urlencode(query)}")
                    found = json.loads(text)
                except (Failed, ValueError):
                    break
                if not (results := found.get("results") or []):
                    break
                yield label, text
                got += len(results)
                if page >= int(found.get("page_count") or 0):
                    break
                page += 1
