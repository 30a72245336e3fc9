"""Settings of the command line: a TOML file, then environment variables."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass
from pathlib import Path

_YES = {"1", "true", "TRUE", "yes"}


@dataclass
class Config:
    home: Path
    sources_path: Path | None = None
    allowlist_mode: bool = True
    registry_enabled: bool = False
    registry_url: str | None = None
    registry_ttl_hours: int = 24
    upload_mode: str = "legacy"
    timeout_seconds: int = 30
    namespace: str | None = None
    worker_url: str | None = None
    worker_token: str | None = None
    index_url: str | None = None
    index_token: str | None = None
    policy_path: Path | None = None
    allow_insecure_http: bool = False
    update_url: str | None = None

    @property
    def ledger(self) -> str:
        return str(self.home / "ledger")


#: Setting, environment variable.
VARIABLES = {
    "home": "EPISODICA_HOME",
    "sources_path": "EPISODICA_SOURCES_PATH",
    "allowlist_mode": "EPISODICA_ALLOWLIST_MODE",
    "registry_enabled": "EPISODICA_REGISTRY_ENABLED",
    "registry_url": "EPISODICA_REGISTRY_URL",
    "upload_mode": "EPISODICA_UPLOAD_MODE",
    "namespace": "EPISODICA_NAMESPACE",
    "worker_url": "EPISODICA_WORKER_URL",
    "worker_token": "EPISODICA_WORKER_TOKEN",
    "index_url": "EPISODICA_INDEX_URL",
    "index_token": "EPISODICA_INDEX_TOKEN",
    "policy_path": "EPISODICA_POLICY_PATH",
    "allow_insecure_http": "EPISODICA_ALLOW_INSECURE_HTTP",
    "update_url": "EPISODICA_UPDATE_URL",
}


def load(path: str | Path | None = None, env: dict[str, str] | None = None) -> Config:
    env = dict(os.environ) if env is None else env
    home = Path(env.get("EPISODICA_HOME") or Path(env.get("HOME", ".")) / ".episodica")
    file = Path(path or env.get("EPISODICA_CONFIG") or home / "config.toml")
    given = tomllib.loads(file.read_text()) if file.exists() else {}
    given |= {k: env[v] for k, v in VARIABLES.items() if v in env}
    given["home"] = Path(given.get("home", home))
    for key in ("allowlist_mode", "registry_enabled", "allow_insecure_http"):
        if isinstance(given.get(key), str):
            given[key] = given[key] in _YES
    for key in ("sources_path", "policy_path"):
        if given.get(key):
            given[key] = Path(given[key])
    return Config(**{k: v for k, v in given.items() if k in Config.__dataclass_fields__})
