"""A polite client for tasks that own their hosts, and the download stage on it."""

from __future__ import annotations

import hashlib
import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
import urllib.robotparser
import uuid

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.config import Http
from gleaner.functions.scalars import url_extension
from gleaner.operators.stage import StageResult, rejection
from gleaner.plans.storage import materialize, system_of


class Failed(Exception):
    """A request that gave nothing; reason is one of the download reasons."""

    def __init__(self, reason: str, detail: str):
        super().__init__(detail)
        self.reason, self.detail = reason, detail[:400]


class Client:
    """Throttled by host, obeys robots files it can read, retries what may pass. One per task: a host is one task's."""

    def __init__(self, cfg: Http = Http(), sleep=time.sleep, clock=time.monotonic, opener=None, token: str | None = None):
        self.headers = {"User-Agent": cfg.user_agent} | ({"Authorization": f"Bearer {token}"} if token else {})
        self.cfg, self.sleep, self.clock = cfg, sleep, clock
        self.open = opener or urllib.request.urlopen
        self.next: dict[str, float] = {}
        self.robots: dict[str, urllib.robotparser.RobotFileParser | None] = {}

    def wait(self, host: str) -> None:
        now = self.clock()
        slot = max(now, self.next.get(host, now))
        self.next[host] = slot + self.cfg.host_delays.get(host, self.cfg.min_delay)
        if slot > now:
            self.sleep(slot - now)

    def allowed(self, url: str) -> bool:
        if not self.cfg.respect_robots:
            return True
        origin = "{0.scheme}://{0.netloc}".format(urllib.parse.urlsplit(url))
        if origin not in self.robots:
            try:
                with self._once(f"{origin}/robots.txt") as r:
                    rules = urllib.robotparser.RobotFileParser()
                    rules.parse(r.read().decode("utf-8", "replace").splitlines())
                    self.robots[origin] = rules
            except Exception:
                self.robots[origin] = None  # unreadable rules leave the site open
        rules = self.robots[origin]
        return rules is None or rules.can_fetch(self.cfg.user_agent, url)

    def _once(self, url: str, data: dict | None = None):
        self.wait(urllib.parse.urlsplit(url).netloc)
        body = None if data is None else urllib.parse.urlencode(data).encode()  # a body makes it a POST
        return self.open(urllib.request.Request(url, data=body, headers=self.headers), timeout=self.cfg.read_timeout)

    def backoff(self, attempt: int, retry_after: str | None) -> float:
        pause = self.cfg.backoff * 2 ** (attempt - 1) * random.uniform(0.5, 1.5)
        try:
            return max(pause, float(retry_after))
        except (TypeError, ValueError):
            return pause

    def request(self, url: str, data: dict | None = None):
        for attempt in range(1, self.cfg.max_tries + 1):
            try:
                return self._once(url, data)
            except urllib.error.HTTPError as e:
                if e.code not in self.cfg.retry_statuses or attempt == self.cfg.max_tries:
                    raise Failed("HTTP_ERROR", "rate limited" if e.code == 429 else f"status {e.code}") from e
                self.sleep(self.backoff(attempt, e.headers.get("Retry-After") if e.headers else None))
            except TimeoutError as e:
                if attempt == self.cfg.max_tries:
                    raise Failed("TIMEOUT", str(e) or "timed out") from e
                self.sleep(self.backoff(attempt, None))
            except OSError as e:
                if attempt == self.cfg.max_tries:
                    raise Failed("HTTP_ERROR", f"{type(e).__name__}: {e}") from e
                self.sleep(self.backoff(attempt, None))
        raise Failed("HTTP_ERROR", "no try was made")

    def text(self, url: str, data: dict | None = None) -> str:
        with self.request(url, data) as r:
            return r.read().decode("utf-8", "replace")

    def page(self, url: str) -> str | None:
        """A page's text; None if robots rules forbid it or nothing came."""
        try:
            return self.text(url) if self.allowed(url) else None
        except (Failed, ValueError):
            return None

    def image(self, url: str) -> tuple[bytes, str]:
        """Bytes and sha256, in chunks, within the size cap."""
        with self.request(url) as r:
            kind = (r.headers.get("Content-Type") or "").split(";")[0].strip().lower()
            if kind and not kind.startswith("image/"):
                raise Failed("NOT_AN_IMAGE", f"content type {kind}")
            sha, parts, size = hashlib.sha256(), [], 0
            while chunk := r.read(1 << 16):
                size += len(chunk)
                if size > self.cfg.max_bytes:
                    raise Failed("TOO_LARGE", f"more than {self.cfg.max_bytes} bytes")
                sha.update(chunk)
                parts.append(chunk)
            if not size:
                raise Failed("EMPTY_RESPONSE", "0 bytes")
            return b"".join(parts), sha.hexdigest()


class TokenLease:
    """A bearer token for client credentials, asked for again shortly before it ends; anonymous when none can be had."""

    def __init__(self, client: Client, url: str, client_id: str | None, client_secret: str | None):
        self.client, self.url, self.id, self.secret = client, url, client_id, client_secret
        self.until = float("-inf")

    def renew(self) -> None:
        """Give the client a token that lasts, if there are credentials."""
        if not (self.id and self.secret) or self.client.clock() < self.until:
            return
        self.client.headers.pop("Authorization", None)
        try:
            got = json.loads(self.client.text(self.url, {"client_id": self.id, "client_secret": self.secret, "grant_type": "client_credentials"}))
            self.client.headers["Authorization"] = f"Bearer {got['access_token']}"
            self.until = self.client.clock() + 0.9 * float(got.get("expires_in") or 3600)
        except (Failed, ValueError, KeyError, TypeError):
            self.until = self.client.clock() + 60  # anonymous until the next try


def host(url: str = "url"):
    return F.regexp_extract(url, r"^[a-z]+://([^/?#]*)", 1)


def dealt_by_host(rows: DataFrame, url: str, tasks: int) -> DataFrame:
    """A host's rows stand in one task, one after another, so that one client keeps the host's delay over all rows and classes. Which host is slow doesn't matter to the others: a host's rate bounds its task however the work is dealt."""
    return rows.repartition(tasks, host(url)).sortWithinPartitions(host(url))


def fetched_pages(urls: DataFrame, cfg: Http = Http(), tasks: int = 8) -> DataFrame:
    """urls: url. url and html of each distinct one; null where robots rules forbid it or nothing came."""

    def run(batches):
        client = Client(cfg)
        for pdf in batches:
            for url in pdf["url"]:
                yield pd.DataFrame({"url": [url], "html": [client.page(url)]})

    return dealt_by_host(urls.select("url").where("url is not null").distinct(), "url", tasks).mapInPandas(run, "url string, html string")


class ContentSink:
    """Bytes under root by their hash, in two phases: a task writes under _staging/<job> and renames to the hash's place, which is the same whoever does it; finish() deletes the job's staging, and with it what lost or speculative tasks left behind."""

    def __init__(self, root: str, job: str | None = None):
        self.root = root.rstrip("/")
        self.staging = f"{self.root}/_staging/{job or uuid.uuid4().hex}"

    def put(self, path: str, content: bytes) -> None:
        system, at = system_of(path)
        _, temp = system_of(f"{self.staging}/{uuid.uuid4().hex}")
        for folder in (at.rpartition("/")[0], temp.rpartition("/")[0]):
            system.create_dir(folder, recursive=True)
        with system.open_output_stream(temp) as f:
            f.write(content)
        system.move(temp, at)

    def finish(self) -> None:
        system, at = system_of(self.staging)
        if system.get_file_info(at).type != fs.FileType.NotFound:
            system.delete_dir(at)


def download(records: DataFrame, root: str, cfg: Http = Http(), tasks: int = 8) -> StageResult:
    """records with sha256, file_size_bytes and storage_path; failures are rejections. The task that fetches bytes writes them under root (a path or URI that all executors reach), so they never travel as a column. Each URL is fetched once, whoever asks for it."""
    sink = ContentSink(root)

    def run(batches):
        client = Client(cfg)
        for pdf in batches:
            rows = []
            for url, suffix in zip(pdf["image_url"], pdf["suffix"], strict=True):
                try:
                    content, sha = client.image(url)
                    path = f"{sink.root}/{sha[:2]}/{sha}{suffix}"
                    sink.put(path, content)
                    rows.append((url, sha, len(content), path, None, None))
                except Failed as e:
                    rows.append((url, None, None, None, e.reason, e.detail))
            out = pd.DataFrame(rows, columns=["image_url", "sha256", "file_size_bytes", "storage_path", "_reason", "_detail"])
            yield out.astype({"file_size_bytes": "Int64"})

    urls = records.select("image_url", url_extension(F.col("image_url")).alias("suffix")).where("image_url is not null").distinct()
    got = dealt_by_host(urls, "image_url", tasks).mapInPandas(run, "image_url string, sha256 string, file_size_bytes long, storage_path string, _reason string, _detail string")
    try:
        got = materialize(got, "downloaded")
    finally:
        sink.finish()
    df = records.join(got, "image_url", "left").withColumn("_reason", F.when(F.col("sha256").isNull(), F.coalesce("_reason", F.lit("HTTP_ERROR"))))
    kept = df.where("_reason is null").drop("_reason", "_detail")
    lost = df.where("_reason is not null")
    return StageResult(kept, rejection(lost, "download", F.col("_reason"), F.col("_detail")))


def existing_paths(paths: DataFrame) -> DataFrame:
    """Of the column storage_path those that name files with bytes, looked up by executors."""

    def run(batches):
        for pdf in batches:
            sizes = []
            for path in pdf["storage_path"]:
                system, at = system_of(path)
                sizes.append(system.get_file_info(at).size or 0)
            yield pdf[[n > 0 for n in sizes]]

    return paths.select("storage_path").where("storage_path is not null").distinct().mapInPandas(run, "storage_path string")
