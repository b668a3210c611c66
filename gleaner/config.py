"""Settings with their defaults; environment variables override, arguments override both."""

from __future__ import annotations

import dataclasses
import json
import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Http:
    connect_timeout: float = 10.0
    read_timeout: float = 30.0
    max_tries: int = 4
    backoff: float = 1.5
    retry_statuses: tuple[int, ...] = (429, 500, 502, 503, 504)
    min_delay: float = 0.5
    host_delays: dict = field(default_factory=lambda: {"upload.wikimedia.org": 1.5})
    max_bytes: int = 20 * 1024 * 1024
    respect_robots: bool = True
    user_agent: str = "gleaner/1.0"


@dataclass(frozen=True)
class Validation:
    min_dimension: int = 64
    max_dimension: int = 8000
    min_bytes: int = 1024
    max_aspect: float = 6.0
    formats: tuple[str, ...] = ("JPEG", "PNG", "WEBP", "GIF", "BMP", "TIFF")
    max_pixels: int = 50_000_000


@dataclass(frozen=True)
class License:
    forbidden: tuple[str, ...] = ("NC", "ND")

    def __post_init__(self):
        elements = tuple(x.strip().upper() for x in self.forbidden)
        if not set(elements) <= {"BY", "NC", "ND", "SA"}:
            raise ValueError(f"unknown licence elements: {elements}")
        object.__setattr__(self, "forbidden", elements)


@dataclass(frozen=True)
class Dedupe:
    enable: bool = True
    max_distance: int = 5
    keep: str = "highest_resolution"

    def __post_init__(self):
        if not 0 <= self.max_distance <= 64 or self.keep not in ("highest_resolution", "first_seen"):
            raise ValueError("max_distance is 0 to 64; keep is highest_resolution or first_seen")


@dataclass(frozen=True)
class Split:
    train_percent: int = 80
    stratify: bool = True
    strategy: str = "stratified_rank"
    #: Fixed value: splits and selections follow from it.
    salt: str = "aicare-v1"

    def __post_init__(self):
        if not 50 <= self.train_percent <= 95 or self.strategy not in ("stratified_rank", "stable_bucket"):
            raise ValueError("train_percent is 50 to 95; strategy is stratified_rank or stable_bucket")


@dataclass(frozen=True)
class Source:
    classes: tuple[str, ...] = ("cat", "dog", "bird")
    target: int = 60
    overfetch: float = 1.5
    minimum: int = 40
    page_size: int = 20
    license_type: str = "commercial,modification"
    max_pages: int = 3
    scrape_cap: int = 25
    subcategories: bool = True
    max_subcategories: int = 8
    #: Where sources are; credentials are read from the environment by the run and stand in no snapshot.
    api_url: str = "https://api.openverse.org/v1"
    site_url: str = "https://commons.wikimedia.org"
    categories: dict = field(default_factory=lambda: {"cat": "Category:Cats", "dog": "Category:Dogs", "bird": "Category:Birds"})


@dataclass(frozen=True)
class Settings:
    http: Http = Http()
    validation: Validation = Validation()
    license: License = License()
    dedupe: Dedupe = Dedupe()
    split: Split = Split()
    source: Source = Source()
    data_dir: str = "data"
    workers: int = 8
    refetch: bool = False

    def snapshot(self) -> str:
        """JSON of all settings; none of them is a secret."""
        return json.dumps(dataclasses.asdict(self), sort_keys=True)


def _parsed(text: str, like):
    if isinstance(like, bool):
        return text.strip().lower() in ("1", "true", "yes", "on")
    if isinstance(like, tuple):
        kind = type(like[0]) if like else str
        return tuple(kind(x.strip()) for x in text.split(",") if x.strip())
    return json.loads(text) if isinstance(like, dict) else type(like)(text)


def load(env: dict[str, str] | None = None, **overrides) -> Settings:
    """Arguments (group__field or field) over the environment (GLEANER_GROUP_FIELD) over defaults."""
    env = os.environ if env is None else env
    groups = {}
    for f in dataclasses.fields(Settings):
        default = f.default
        if dataclasses.is_dataclass(default):
            values = {}
            for g in dataclasses.fields(default):
                if (name := f"GLEANER_{f.name}_{g.name}".upper()) in env:
                    values[g.name] = _parsed(env[name], getattr(default, g.name))
                if f"{f.name}__{g.name}" in overrides:
                    values[g.name] = overrides[f"{f.name}__{g.name}"]
            groups[f.name] = dataclasses.replace(default, **values)
        else:
            text = env.get(f"GLEANER_{f.name}".upper())
            groups[f.name] = overrides.get(f.name, default if text is None else _parsed(text, default))
    return Settings(**groups)
