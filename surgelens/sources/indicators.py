"""Indicator sets: network ranges, autonomous systems, countries, user agents and URIs."""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Network:
    label: str
    order: int
    version: int
    prefix: int
    number: int


@dataclass(frozen=True)
class Indicators:
    """Validated indicators, each list in configuration order."""

    networks: tuple[Network, ...] = ()
    countries: tuple[str, ...] = ()
    user_agents: tuple[str, ...] = ()
    uris: tuple[str, ...] = ()
    user_agent_patterns: tuple[str, ...] = ()
    uri_patterns: tuple[str, ...] = ()
    asns: tuple[str, ...] = ()
    # Rule kinds (``CIDR``) or whole rules (``Country:KP``) and what a match counts.
    weights: tuple[tuple[str, float], ...] = ()

    @classmethod
    def from_config(cls, config: Mapping) -> "Indicators":
        """Build from a parsed document; bad networks or patterns raise here."""
        patterns = config.get("regex") or {}
        networks = []
        for order, text in enumerate(config.get("cidrs") or []):
            net = ipaddress.ip_network(text)
            networks.append(Network(str(net), order, net.version, net.prefixlen, int(net.network_address)))
        texts = lambda values: tuple(dict.fromkeys(values or []))
        found = cls(
            networks=tuple(networks),
            countries=texts(config.get("country")),
            user_agents=texts(config.get("ua")),
            uris=texts(config.get("uri")),
            user_agent_patterns=texts(patterns.get("ua")),
            uri_patterns=texts(patterns.get("uri")),
            asns=texts(config.get("asn")),
            weights=tuple((str(k), float(v)) for k, v in (config.get("weights") or {}).items()),
        )
        for name, weight in found.weights:
            if not 0 <= weight < float("inf"):
                raise ValueError(f"the weight of {name!r} must be a number from 0 on")
        for asn in found.asns:
            if not re.fullmatch("AS[0-9]{1,10}", asn):
                raise ValueError(f"not an autonomous system: {asn!r}")
        for pattern in found.user_agent_patterns + found.uri_patterns:
            re.compile(pattern)
        return found

    def is_empty(self) -> bool:
        return not (
            self.networks
            or self.countries
            or self.user_agents
            or self.uris
            or self.user_agent_patterns
            or self.uri_patterns
            or self.asns
        )


def load_indicators(path: str, spark: SparkSession | None = None) -> Indicators:
    """Read a YAML indicator file. A missing or broken file raises.

    With a session, the file is read through the file system its path belongs to.
    """
    import yaml

    if spark is not None:
        return Indicators.from_config(yaml.safe_load(spark.read.text(path, wholetext=True).first()["value"]) or {})
    with open(path, encoding="utf-8") as f:
        return Indicators.from_config(yaml.safe_load(f) or {})
