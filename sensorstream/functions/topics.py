"""Topic names: patterns, filters, rewriting, naming."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorstream import fixed


def own_device_pattern(owner: str) -> str:
    return fixed.OWN_DEVICE_PATTERN.format(owner=re.escape(owner))


def topic_matches(topic: Column, pattern: str = fixed.ALL_DEVICES_PATTERN) -> Column:
    """Full match, as a pattern subscription does it."""
    return topic.rlike(rf"^(?:{pattern})\z")


def split_filters(filters: str) -> list[str]:
    """A subscription list separated by any run of white space."""
    return filters.split()


def mqtt_filter_pattern(filters: str) -> str:
    """One regular expression for a white-space separated list of MQTT filters.

    `+` stands for one level; a closing `#` for the level above it and all below.
    """
    alternatives = []
    for name in split_filters(filters):
        levels = name.split("/")
        if "#" in levels[:-1] or any(c in level and level != c for level in levels for c in "+#"):
            raise ValueError(f"not an MQTT filter: {name!r}")
        below = levels[-1] == "#"
        parts = ["[^/]*" if level == "+" else re.escape(level) for level in levels[: len(levels) - below]]
        if below:
            alternatives.append("/".join(parts) + "(?:/.*)?" if parts else ".*")
        else:
            alternatives.append("/".join(parts))
    if not alternatives:
        raise ValueError("the filter list is empty")
    return "|".join(alternatives)


def mqtt_matches(topic: Column, filters: str) -> Column:
    return topic.rlike(rf"(?s)^(?:{mqtt_filter_pattern(filters)})\z")


def device_topics(device: str, metrics=fixed.DEVICE_METRICS) -> list[str]:
    base = fixed.MQTT_BASE.format(device=device)
    return [base + metric for metric in metrics]


def to_kafka_topic(topic: Column, separator: str = fixed.TOPIC_SEPARATOR) -> Column:
    return F.replace(topic, F.lit("/"), F.lit(separator))


def is_legal_kafka_topic(topic: Column) -> Column:
    """Kafka's own rule for topic names."""
    return topic.rlike(r"^[a-zA-Z0-9._-]{1,249}\z") & ~topic.isin(".", "..")


def strip_prefix(topic: Column, prefix: str) -> Column:
    return F.when(F.startswith(topic, F.lit(prefix)), F.substr(topic, F.lit(len(prefix) + 1))).otherwise(topic)


def fill_name(template: str, **columns: Column | str) -> Column:
    """'a-{x}-b' with {x} taken from a column or a constant."""
    pieces = re.split(r"\{(\w+)\}", template)
    parts = []
    for i, piece in enumerate(pieces):
        if i % 2 == 0:
            if piece:
                parts.append(F.lit(piece))
        else:
            given = columns[piece]
            parts.append(F.lit(given) if isinstance(given, str) else given)
    return F.concat(*parts)
