"""The feed job from end to end: base once, gates, channels, dated exports."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame

from storelens.operators.staging import stage
from storelens.plans.feeds.base import base_feed, require_rows, require_valid, validate_feed
from storelens.plans.feeds.channels import CHANNELS
from storelens.sources.sinks import dated_name, write_quoted_csv


def run_feeds(
    t: Mapping[str, DataFrame],
    cfg,
    as_of: datetime,
    folder: str,
    names: tuple[str, ...] = tuple(CHANNELS),
    write: Callable[[DataFrame, str], None] = write_quoted_csv,
) -> dict[str, str]:
    """Exports the named channels and returns their paths.

    The base is built and staged once and must pass its gate; so must each channel, before
    any of its rows leave. A channel that fails ends the run; channels before it stay exported.
    """
    base = stage(base_feed(t, cfg, as_of))
    require_valid(validate_feed(base))
    paths = {}
    for name in names:
        feed = stage(CHANNELS[name](base, cfg))
        require_rows(feed, name)
        paths[name] = f"{folder}/{dated_name(name, as_of)}"
        write(feed, paths[name])
    return paths
