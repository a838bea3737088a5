"""Options of a harvest, an enrichment and a publication, from the environment and a command line."""

from __future__ import annotations

import argparse
import os
import re
from collections.abc import Mapping


def ids(*names: str, env: Mapping[str, str] | None = None) -> tuple[str, ...]:
    """The first of the variables that isn't empty, cut at commas and line ends."""
    env = os.environ if env is None else env
    raw = next((env[n] for n in names if env.get(n, "").strip()), "")
    return tuple(x.strip() for x in re.split(r"[,\n]", raw) if x.strip())


def parsed(arguments: list[str]) -> argparse.Namespace:
    """backfill, limit, only, list of a harvest; retry, refetch, prune, gaps, merge, limit of an enrichment; json, discord, page of a publication."""
    p = argparse.ArgumentParser(add_help=False)
    for flag in ("backfill", "list", "retry", "prune"):
        p.add_argument(f"--{flag}", action="store_true")
    for name in ("refetch", "gaps", "merge", "json", "discord", "page"):
        p.add_argument(f"--{name}")
    p.add_argument("--limit", type=int)
    p.add_argument("--only", type=lambda v: tuple(x for x in v.split(",") if x))
    return p.parse_args(arguments)
