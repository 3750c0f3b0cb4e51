"""Matching records against indicator sets.

Every kind of indicator adds at most one rule to a row, and none of them
shuffles the rows: short lists become literals, long ones broadcast joins (or, for
networks, a flat index) while their size stays inside the bound, and plain
equi-joins beyond it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens import session
from surgelens.functions.addresses import hex_number, high_bits, ipv4_number, ipv6_hex, let
from surgelens.functions.networks import NetworkIndex
from surgelens.functions.patterns import PatternIndex
from surgelens.operators.hotspots import REQUESTS, WAF
from surgelens.session import broadcast_within, written
from surgelens.sources.indicators import Indicators, Network

# Lists up to this long are tested as literals instead of joined.
LITERALS = 200
NETWORK_LITERALS = 64
# Patterns up to this many are tried one after the other on every text.
PATTERNS = 64
# More distinct prefix lengths than this are widened to whole bytes.
PREFIX_LENGTHS = 8
# Parts that a value's rows are spread over where a list is too long to broadcast.
SALTS = 16
# Leading bits that name a block of addresses when ranges are looked up.
BLOCK_BITS = 16
# All of these choose between plans; the results are the same.

# The prefixes of rule names.
CIDR, COUNTRY = "CIDR", "Country"
UA_EXACT, UA_REGEX = "UA_Exact", "UA_Regex"
URI_EXACT, URI_REGEX = "URI_Exact", "URI_Regex"
ASN = "ASN"

RULES = ("cidr_rule", "country_rule", "ua_rule", "ua_regex_rule", "uri_rule", "uri_regex_rule")


def _local_table(df: DataFrame, columns: dict[str, pa.Array]) -> DataFrame:
    """A driver-built table the planner knows row by row, hence by size."""
    return df.sparkSession.createDataFrame(pa.table(columns))


def _exact_rule(c: Column, values: Sequence[str], label: str) -> Column:
    found = c.isin(list(values)) if values else F.lit(False)
    return F.when((c != "") & found, F.concat(F.lit(label + ":"), c))


def _look_up(df: DataFrame, listed: DataFrame, keys: dict[str, Column], size: int) -> DataFrame:
    """Left join with a list of distinct keys, given its bytes.

    Inside the broadcast bound no row moves. Beyond it both sides are shuffled by
    key and a salt, which follows from the whole row: rows that share one
    frequent value, or have none, are spread over ``SALTS`` tasks.
    """
    hinted = broadcast_within(listed, 1, size)
    matches = F.lit(True)
    for name, have in keys.items():
        matches = matches & (have == F.col(name))
    if hinted is listed:
        hashed = [F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
        df = df.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.lit(SALTS).cast("bigint")))
        salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
        hinted = listed.withColumn("_salt_of_list", F.explode(salts))
        matches = matches & (F.col("_salt") == F.col("_salt_of_list"))
    return df.join(hinted, matches, "left").drop(*keys, "_salt", "_salt_of_list")


def _match_listed(df: DataFrame, column: str, listed: DataFrame, size: int, label: str, out: str) -> DataFrame:
    c = F.col(column)
    joined = _look_up(df, listed.withColumn("_is_listed", F.lit(True)), {"_listed": c}, size)
    return joined.withColumn(out, F.when(F.col("_is_listed"), F.concat(F.lit(label + ":"), c))).drop("_is_listed")


def _match_exact(df: DataFrame, column: str, values: Sequence[str], label: str, out: str) -> DataFrame:
    if len(values) <= LITERALS:
        return df.withColumn(out, _exact_rule(F.col(column), values, label))
    listed = _local_table(df, {"_listed": pa.array(list(dict.fromkeys(v for v in values if v)), pa.string())})
    return _match_listed(df, column, listed, sum(64 + 2 * len(v) for v in values), label, out)


def match_uri_table(df: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """Adds ``uri_rule`` from a table of URIs (its first column), however long.

    The list is measured, in one pass of its own, and never comes to the driver.
    """
    uri = F.col(listed.columns[0])
    distinct = listed.where(uri != "").select(uri.alias("_listed")).distinct()
    size = distinct.agg(F.sum(64 + F.octet_length("_listed"))).first()[0] or 0
    return _match_listed(df, column, distinct, size, URI_EXACT, "uri_rule")


def _many_patterns(df: DataFrame, column: str, patterns: Sequence[str], label: str, out: str) -> DataFrame:
    """First pattern, in order, found anywhere, for long lists: an index of the literals
    that patterns require names the few to try on a text, and only those are tried."""
    index = PatternIndex(patterns)

    @F.pandas_udf("array<string>")
    def likely(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([index.candidates(t) if t else [] for t in texts.tolist()], dtype="object")

    c = F.col(column)
    found = F.filter("_likely", lambda p: F.rlike(c, F.concat(F.lit("(?idU)"), p)))
    rule = F.concat(F.lit(label + ":"), F.get(found, F.lit(0)))
    return df.withColumn("_likely", likely(c)).withColumn(out, rule).drop("_likely")


def _match_patterns(df: DataFrame, column: str, patterns: Sequence[str], label: str, out: str) -> DataFrame:
    if len(patterns) > PATTERNS:
        return _many_patterns(df, column, patterns, label, out)
    return df.withColumn(out, _pattern_rule(F.col(column), patterns, label))


def _pattern_rule(c: Column, patterns: Sequence[str], label: str) -> Column:
    """First pattern, in order, found anywhere; later ones are not evaluated."""
    # Case-insensitive over all of Unicode, with newline as the only line end.
    tests = [F.when(c.rlike("(?idU)" + p), F.lit(f"{label}:{p}")) for p in patterns]
    return F.when(c != "", F.coalesce(*tests) if tests else F.lit(None).cast("string"))


def match_country(df: DataFrame, column: str, found: Indicators) -> DataFrame:
    return _match_exact(df, column, found.countries, COUNTRY, "country_rule")


def match_user_agent(df: DataFrame, column: str, found: Indicators) -> DataFrame:
    exact = _match_exact(df, column, found.user_agents, UA_EXACT, "ua_rule")
    return _match_patterns(exact, column, found.user_agent_patterns, UA_REGEX, "ua_regex_rule")


def match_uri(df: DataFrame, column: str, found: Indicators) -> DataFrame:
    exact = _match_exact(df, column, found.uris, URI_EXACT, "uri_rule")
    return _match_patterns(exact, column, found.uri_patterns, URI_REGEX, "uri_regex_rule")


def match_asn(df: DataFrame, column: str, found: Indicators) -> DataFrame:
    return _match_exact(df, column, found.asns, ASN, "asn_rule")


def with_asn(df: DataFrame, column: str, ranges: DataFrame, out: str = "asn") -> DataFrame:
    """Adds the autonomous system whose range holds the IPv4 address in ``column``.

    ``ranges`` has ``first`` and ``last`` (addresses as numbers, both included) and
    ``asn``, and its ranges don't overlap; if they do, the one that starts last
    counts. Addresses outside all ranges, of version 6, or malformed get NULL.

    Each distinct address is looked up once, whatever share of the rows it has:
    within the ``2^(32 - BLOCK_BITS)`` addresses of a block, addresses and range starts are
    sorted and an address takes the start before it. A range is listed once for
    each block it touches, at most the number of blocks more rows than ranges.
    """
    bits = 32 - BLOCK_BITS
    address = ipv4_number(F.col("_ip")).alias("_at")
    asked = df.select(F.col(column).alias("_ip")).where(F.col(column).isNotNull()).distinct()
    asked = asked.select("_ip", address).where("_at IS NOT NULL")
    asked = asked.select("_ip", "_at", F.shiftright("_at", bits).alias("_block"), F.lit(None).cast("struct<last:bigint,asn:string>").alias("_range"))
    held = F.struct(F.col("last").cast("bigint").alias("last"), F.col("asn").cast("string").alias("asn")).alias("_range")
    whole = ranges.where("first <= last").select(F.col("first").cast("bigint").alias("_at"), F.col("last").cast("bigint").alias("_last"), held)
    blocks = F.sequence(F.shiftright("_at", bits), F.shiftright("_last", bits))
    starts = whole.withColumn("_block", F.explode(blocks)).select(
        F.lit(None).cast("string").alias("_ip"), F.greatest("_at", F.shiftleft("_block", bits)).alias("_at"), "_block", "_range"
    )
    # At one address, the range that starts there comes first.
    before = F.expr("last(_range, true) OVER (PARTITION BY _block ORDER BY _at, _ip NULLS FIRST ROWS UNBOUNDED PRECEDING)")
    found = starts.unionByName(asked).withColumn("_range", before).where("_ip IS NOT NULL AND _at <= _range.last")
    table = written(found.select(F.col("_ip").alias("_listed"), F.col("_range.asn").alias(out)), "asn")
    rows = table.count()
    return _look_up(df, table, {"_listed": F.col(column)}, rows * 96)


def _by_prefix(networks: Sequence[Network]) -> dict[int, list[Network]]:
    """Distinct networks, the earlier of equal ones, by prefix length.

    Many distinct lengths are widened to the next whole byte, which bounds the
    number of joins.
    """
    widen = len({n.prefix for n in networks}) > PREFIX_LENGTHS
    distinct: dict[tuple[int, int], Network] = {}
    for net in sorted(networks, key=lambda n: n.order):
        distinct.setdefault((net.number, net.prefix), net)
    tables: dict[int, list[Network]] = {}
    for net in distinct.values():
        tables.setdefault(-(-net.prefix // 8) * 8 if widen else net.prefix, []).append(net)
    return tables


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def _prefix_keys(version: int, length: int, address: Column) -> list[Column]:
    """The address' leading bits as one (IPv4) or two (IPv6) numbers."""
    if version == 4:
        return [high_bits(address, length, 32)]
    return [high_bits(address["high"], min(length, 64), 64), high_bits(address["low"], max(length - 64, 0), 64)]


def _address(ip: Column, version: int) -> Column:
    """IPv4 as a number, IPv6 as a struct of two; NULL if it is neither."""
    if version == 4:
        return ipv4_number(ip)

    def halves(digits: Column) -> Column:
        high, low = F.substring(digits, 1, 16), F.substring(digits, 17, 16)
        return F.when(digits.isNotNull(), F.struct(hex_number(high).alias("high"), hex_number(low).alias("low")))

    return let(ipv6_hex(ip), halves)


def _network_keys(version: int, length: int, bits: int) -> tuple[int, ...]:
    if version == 4:
        return (bits,)
    if length <= 64:
        return (_signed(bits), 0)
    return (_signed(bits >> (length - 64)), _signed(bits & ((1 << (length - 64)) - 1)))


def _first_network(address: Column, networks: Sequence[Network], version: int) -> Column:
    """Few networks: one comparison each, in configuration order."""
    tests = []
    for net in networks:
        bits = net.number >> ((32 if version == 4 else 128) - net.prefix)
        inside = address.isNotNull()
        for have, want in zip(
            _prefix_keys(version, net.prefix, address), _network_keys(version, net.prefix, bits)
        ):
            inside = inside & (have == F.lit(want).cast("bigint"))
        tests.append(F.when(inside, F.lit(f"{CIDR}:{net.label}")))
    return F.coalesce(*tests)


def _prefix_table(
    df: DataFrame, networks: Sequence[Network], version: int, length: int, keys: Sequence[str], hit: str
) -> DataFrame:
    """Leading bits and first network of each; shorter prefixes are spelled out by Spark."""
    width = 32 if version == 4 else 128
    firsts = [_network_keys(version, length, n.number >> (width - length)) for n in networks]
    columns = {k: pa.array([f[i] for f in firsts], pa.int64()) for i, k in enumerate(keys)}
    columns["_more"] = pa.array([(1 << (length - n.prefix)) - 1 for n in networks], pa.int64())
    columns["_order"] = pa.array([n.order for n in networks], pa.int32())
    columns["_label"] = pa.array([n.label for n in networks], pa.string())
    nets = _local_table(df, columns)
    network = F.struct(F.col("_order").alias("order"), F.col("_label").alias("label"))
    if all(n.prefix == length for n in networks):
        return nets.select(*keys, network.alias(hit))
    # A network spans at most a byte's worth of one number, and never its sign.
    growing = keys[0] if length <= 64 else keys[1]
    step = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_more")))
    spelled = nets.withColumn("_step", step).withColumn(growing, F.col(growing) + F.col("_step"))
    return spelled.groupBy(*keys).agg(F.min(network).alias(hit))


def _match_version(df: DataFrame, column: str, networks: Sequence[Network], version: int, out: str) -> DataFrame:
    number = f"_address{version}"
    df = df.withColumn(number, _address(F.col(column), version))
    hits: list[str] = []
    for length, listed in sorted(_by_prefix(networks).items()):
        keys = [f"_n{version}_{length}_{i}" for i in range(1 if version == 4 else 2)]
        hits.append(f"_hit{version}_{length}")
        nets = _prefix_table(df, listed, version, length, keys, hits[-1])
        size = 128 * sum(1 << (length - n.prefix) for n in listed)
        df = _look_up(df, nets, dict(zip(keys, _prefix_keys(version, length, F.col(number)))), size)
    first = F.array_min(F.array_compact(F.array(*[F.col(h) for h in hits])))["label"]
    return df.withColumn(out, F.concat(F.lit(CIDR + ":"), first)).drop(number, *hits)


def _of_version(found: Indicators, version: int) -> list[Network]:
    return [n for n in found.networks if n.version == version]


def _indexed(networks: Sequence[Network], version: int) -> Callable[[Column], Column] | None:
    """The rule of an address by one look-up in a flat index, which goes to the tasks
    with the function; None if the index is larger than may be sent."""
    index = NetworkIndex(networks, version)
    if index.nbytes() > session.BROADCAST_BYTES:
        return None

    @F.pandas_udf("string")
    def rule(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if x is None else f"{CIDR}:{x}" for x in index.find(texts.tolist())], dtype="object")

    return rule


def _version_rule(ip: Column, networks: Sequence[Network], version: int) -> Column:
    return let(_address(ip, version), lambda a: _first_network(a, networks, version))


def _network_rule(ip: Column, found: Indicators) -> Column:
    networks = _of_version(found, 4)
    return _version_rule(ip, networks, 4) if networks else F.lit(None).cast("string")


def match_cidr(df: DataFrame, column: str, found: Indicators) -> DataFrame:
    """First network, in configuration order, that holds the address.

    A short list of version 4 is compared in place. Any other list is a flat index
    that each batch of addresses is looked up in, without moving a row. One that
    is too large to send is joined: each distinct prefix length is one look-up on
    the leading bits, and as two different networks of one length never overlap,
    no row is multiplied.
    """
    short, rules = len(found.networks) <= NETWORK_LITERALS, []
    for version in (4, 6):
        networks = _of_version(found, version)
        if not networks:
            continue
        rules.append(f"_rule{version}")
        if short and version == 4:
            df = df.withColumn(rules[-1], _version_rule(F.col(column), networks, version))
        elif look_up := _indexed(networks, version):
            # Texts of the other version aren't sent to Python.
            mark = F.lit(":" if version == 6 else ".")
            df = df.withColumn(rules[-1], look_up(F.when(F.contains(F.col(column), mark), F.col(column))))
        else:
            df = _match_version(df, column, networks, version, rules[-1])
    rule = F.coalesce(*rules) if rules else F.lit(None).cast("string")
    return df.withColumn("cidr_rule", rule).drop(*rules)


def _is_short(found: Indicators) -> bool:
    lists = (found.countries, found.user_agents, found.uris)
    few = len(found.networks) <= NETWORK_LITERALS and not _of_version(found, 6)
    few = few and max(len(found.user_agent_patterns), len(found.uri_patterns)) <= PATTERNS
    return few and all(len(x) <= LITERALS for x in lists)


def _all_rules(r: Column, found: Indicators) -> Column:
    return F.array_compact(
        F.array(
            _network_rule(r["ip"], found),
            _exact_rule(r["country"], found.countries, COUNTRY),
            _exact_rule(r["ua"], found.user_agents, UA_EXACT),
            _pattern_rule(r["ua"], found.user_agent_patterns, UA_REGEX),
            _exact_rule(r["uri"], found.uris, URI_EXACT),
            _pattern_rule(r["uri"], found.uri_patterns, URI_REGEX),
        )
    )


def match_all(
    df: DataFrame,
    found: Indicators,
    ip: str = "client_ip",
    country: str = "country",
    user_agent: str = "user_agent",
    uri: str = "uri",
    asn: str | None = None,
) -> DataFrame:
    """Adds ``matched`` and ``rules``: network, country, user agent, URI, in this order,
    then the autonomous system, for rows that have a column ``asn`` (see ``with_asn``).

    Short lists make one expression that reads its inputs once, so that a
    filter on the outcome can move towards the scan without copying them.
    """
    if _is_short(found):
        inputs = F.struct(
            F.col(ip).alias("ip"), F.col(country).alias("country"), F.col(user_agent).alias("ua"), F.col(uri).alias("uri")
        )
        out = df.withColumn("rules", let(inputs, lambda r: _all_rules(r, found)))
    else:
        out = match_cidr(df, ip, found)
        out = match_country(out, country, found)
        out = match_user_agent(out, user_agent, found)
        out = match_uri(out, uri, found)
        out = out.withColumn("rules", F.array_compact(F.array(*[F.col(r) for r in RULES]))).drop(*RULES)
    if asn is not None and found.asns:
        out = match_asn(out, asn, found)
        out = out.withColumn("rules", F.array_compact(F.concat("rules", F.array("asn_rule")))).drop("asn_rule")
    return out.withColumn("matched", F.size("rules") > 0)


def keep_matched(df: DataFrame, found: Indicators, **columns: str) -> DataFrame:
    """Rows with at least one rule."""
    return match_all(df, found, **columns).where("matched").drop("matched", "rules")


def drop_matched(df: DataFrame, found: Indicators, **columns: str) -> DataFrame:
    """Rows without any rule."""
    return match_all(df, found, **columns).where(~F.col("matched")).drop("matched", "rules")


def tag_findings(findings: DataFrame, found: Indicators | None, details: DataFrame | None = None) -> DataFrame:
    """Adds ``ioc_matches`` (NULL if none). The subkey is a URI only for web requests.

    A finding is the sum of all countries and user agents of its minute.
    ``details``, the counts it was summed from, brings them back: every one is
    matched, and the largest group's fill the finding's own columns. Only rows of
    findings are looked at.
    """
    if details is not None:
        return _tag_from_details(findings, found, details)
    if found is None or found.is_empty():
        return findings.withColumn("ioc_matches", F.lit(None).cast("array<string>"))
    is_web = (F.col("source_type") == WAF) | (F.col("source_type").isNull() & (F.col("metric") == REQUESTS))
    tagged = match_all(
        findings.withColumn("_uri", F.when(is_web, F.col("subkey"))),
        found,
        ip="key",
        country="country",
        user_agent="ua",
        uri="_uri",
    )
    return tagged.withColumn("ioc_matches", F.when(F.col("matched"), F.col("rules"))).drop("_uri", "matched", "rules")


def _tag_from_details(findings: DataFrame, found: Indicators | None, details: DataFrame) -> DataFrame:
    at = ["metric", "key", "subkey", "minute"]
    groups = details.join(findings.select(*at).distinct(), at, "left_semi")
    largest = F.max(F.struct("value", "country", "ua")).alias("most")
    shown = groups.groupBy(*at).agg(largest).select(*at, F.col("most.country").alias("country"), F.col("most.ua").alias("ua"))
    named = findings.drop("country", "ua").join(shown, at, "left").select(*findings.columns)
    rows = tag_findings(groups.select(*at, "country", "ua", "source_type").distinct(), found)
    # Rule names sort as kinds do: network, country, user agent, URI.
    rules = rows.select(*at, F.explode("ioc_matches").alias("rule")).groupBy(*at)
    return named.join(rules.agg(F.array_sort(F.collect_set("rule")).alias("ioc_matches")), at, "left")


def risk(rules: Column, found: Indicators) -> Column:
    """What the matched rules weigh together: a rule's own weight, else its kind's, else
    1; 0 without rules."""
    weight = F.lit(1.0)
    if found.weights:
        known = F.create_map(*[F.lit(x) for pair in found.weights for x in pair])
        weight = lambda r: F.coalesce(F.element_at(known, r), F.element_at(known, F.substring_index(r, ":", 1)), F.lit(1.0))
        total = F.aggregate(rules, F.lit(0.0), lambda s, r: s + weight(r))
    else:
        total = F.size(rules).cast("double")
    return F.when(rules.isNull(), 0.0).otherwise(total)


def ranked_by_risk(tagged: DataFrame, found: Indicators, top_k: int | None = None) -> DataFrame:
    """Tagged findings with ``risk``, the riskiest first, then the strongest; ``top_k``
    keeps that many, and only then are they in order."""
    rows = tagged.withColumn("risk", risk(F.col("ioc_matches"), found))
    if top_k is None:
        return rows
    return rows.orderBy(F.desc("risk"), F.abs("score").desc(), "metric", "key", "subkey", "minute").limit(top_k)
