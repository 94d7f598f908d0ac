"""Options: what is given, else the configuration's defaults, else fixed ones. Keys come from the environment first."""

from __future__ import annotations

import os
import posixpath
from dataclasses import dataclass, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class SearchOptions:
    count: int = 20
    time_range: str = "45d"
    auth_level: int = 0
    need_url: bool = True
    need_content: bool = False
    sites: str = ""
    block_hosts: str = ""
    industry: str = ""
    content_format: str = "markdown"

    @classmethod
    def resolve(cls, given: dict, defaults: dict | None = None) -> SearchOptions:
        """None means not given; lists become comma-separated texts."""
        out = cls()
        for f in fields(cls):
            for source in (given, defaults or {}):
                if (x := source.get(f.name)) is not None:
                    x = ",".join(map(str, x)) if isinstance(x, (list, tuple)) else x
                    out = replace(out, **{f.name: type(getattr(out, f.name))(x)})
                    break
        if not 1 <= out.count <= 50:
            raise ValueError("count must be from 1 to 50")
        return out

    def payload(self, query: str, time_range: str | None) -> dict:
        """A request: optional parts only where they say something. More than 20 sites or 5 blocked hosts are refused."""
        sites, blocked = ([x.strip() for x in text.split(",") if x.strip()] for text in (self.sites, self.block_hosts))
        if len(sites) > 20 or len(blocked) > 5:
            raise ValueError("at most 20 sites and 5 blocked hosts")
        wanted = {"NeedUrl": self.need_url, "NeedContent": self.need_content}
        body: dict = {"Query": query, "SearchType": "web", "Count": self.count, "Filter": wanted, "ContentFormats": self.content_format}
        if time_range:
            body["TimeRange"] = time_range
        if sites:
            body["Filter"]["Sites"] = "|".join(sites)
        if blocked:
            body["Filter"]["BlockHosts"] = "|".join(blocked)
        if self.auth_level:
            body["Filter"]["AuthInfoLevel"] = self.auth_level
        if self.industry:
            body["Industry"] = self.industry
        return body


def api_key(variable: str, config: dict, placeholder: str = "YOUR_") -> str:
    """A key from the environment, else from the configuration unless it is the placeholder there."""
    key = os.environ.get(variable) or config.get("api_key") or ""
    if not key or key.startswith(placeholder):
        raise ValueError(f"no key: set {variable}")
    return key


def run_folder(path: str) -> str:
    """A run's folder, given that or its `pipeline` folder."""
    bare = path.rstrip("/")
    return posixpath.dirname(bare) if posixpath.basename(bare) == "pipeline" else bare


def _place(path: str) -> tuple[str, str]:
    """Store and path, parents of `..` taken out; links of a local disk are followed."""
    scheme, _, rest = path.partition("://")
    if not rest or scheme == "file":
        return "file", str(Path(path.removeprefix("file://")).resolve())
    host, _, inner = rest.partition("/")
    return f"{scheme}://{host}", posixpath.normpath("/" + inner)


def within(path: str, folder: str) -> bool:
    """Whether a path lies in a folder (or is it), of a local disk or of any store."""
    (store, inner), (other, outer) = _place(path), _place(folder)
    return store == other and (inner == outer or inner.startswith(outer.rstrip("/") + "/"))
