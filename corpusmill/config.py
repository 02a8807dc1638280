"""Configuration: nested values with attribute access, deep merge, and what follows from a domain."""

from __future__ import annotations

import copy
from urllib.parse import urlsplit


class Config:
    """Nested dicts by attribute or key; what is missing is None."""

    def __init__(self, values: dict | None = None) -> None:
        self._values = values or {}

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        v = self._values.get(name)
        return Config(v) if isinstance(v, dict) else v

    __getitem__ = __getattr__

    def get(self, name: str, default=None):
        return self._values.get(name, default)

    def to_dict(self) -> dict:
        return copy.deepcopy(self._values)


def merge(base: dict, site: dict) -> dict:
    """base with site over it: scalars replace, lists are appended, dicts merge."""
    out = copy.deepcopy(base)
    for k, v in site.items():
        old = out.get(k)
        out[k] = merge(old, v) if isinstance(old, dict) and isinstance(v, dict) else [*old, *v] if isinstance(old, list) and isinstance(v, list) else copy.deepcopy(v)
    return out


def domain_of(url: str) -> str:
    """Network location without a leading www.; a bare domain is itself."""
    return (urlsplit(url).netloc if "://" in url else url.split("/")[0]).removeprefix("www.")


def resolve(base: dict, sites: dict[str, dict], url: str | None = None) -> Config:
    """base merged with the site's part, with base_url, domain and domain_slug."""
    if not url:
        return Config(base)
    domain = domain_of(url)
    parts = urlsplit(url)
    origin = f"{parts.scheme}://{parts.netloc}" if parts.netloc else f"https://{domain}"
    return Config(merge(base, sites.get(domain, {})) | {"base_url": origin, "domain": domain, "domain_slug": domain.replace(".", "_")})
