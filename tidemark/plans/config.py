"""Settings with their defaults, from TOML and the environment."""

from __future__ import annotations

import os
import re
import tomllib
from dataclasses import dataclass, field, fields


@dataclass
class Settings:
    batch_rows: int = 50_000
    batch_bytes: int = 64 << 20
    flush_seconds: int = 30
    transaction_bytes: int = 128 << 20
    rows_per_partition: int = 500_000
    parallel_tables: int = 4
    heartbeat_seconds: int = 300
    idle_seconds: int = 60
    poll_seconds: int = 5
    files_per_batch: int = 100
    max_retries: int = 3
    compaction_hours: int = 6
    compaction_threshold: int = 50
    cleanup_hours: int = 24
    streaming: bool = False
    password: str = ""
    password_env: str = ""
    tls_mode: str = "disable"
    tables: dict[str, list[str]] = field(default_factory=dict)

    def secret(self, env: dict | None = None) -> str:
        """The environment first, then the file, then the variable that the file names."""
        env = os.environ if env is None else env
        return env.get("TIDEMARK_PASSWORD") or self.password or env.get(self.password_env, "")


TLS_MODES = ("disable", "prefer", "require", "verify-ca", "verify-full")


def load(text: str = "", env: dict | None = None) -> Settings:
    """Values of the file, overridden by TIDEMARK_<NAME>."""
    env = os.environ if env is None else env
    given = tomllib.loads(text)
    out = Settings()
    for f in fields(Settings):
        raw = env.get(f"TIDEMARK_{f.name.upper()}", given.get(f.name))
        if raw is None:
            continue
        now = getattr(out, f.name)
        if isinstance(now, bool):
            raw = str(raw).lower() in ("1", "true", "yes", "on")
        elif isinstance(now, int):
            raw = int(raw)
        setattr(out, f.name, raw)
    if out.tls_mode not in TLS_MODES:
        raise ValueError(f"tls_mode is one of {', '.join(TLS_MODES)}")
    return out


def quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def snapshot_name(name: str) -> str:
    if not re.fullmatch(r"[0-9A-Fa-f-]+", name):
        raise ValueError(f"not a snapshot's name: {name!r}")
    return name
