import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from surgelens.functions import patterns as P
from surgelens.functions.addresses import ipv4_number, ipv6_hex
from surgelens.operators import indicators
from surgelens.sources.indicators import Indicators, load_indicators

CONFIG = {
    "cidrs": ["172.29.6.0/24"],
    "asn": ["AS64500"],
    "country": ["ZW"],
    "ua": ["Gullprobe"],
    "uri": ["/tern-nest"],
    "regex": {"ua": ["(?i)nestscan"], "uri": ["/var/keyring", "(?i)UNION.*INTO"]},
}
RECORD = "client_ip string, country string, user_agent string, uri string"


def long_version(found):
    """The same indicators in lists too long to be tested in place."""
    pad = [f"zz{i}" for i in range(indicators.LITERALS + 1)]
    nets = [str(ipaddress.ip_network((0xF0000000 + (i << 8), 24))) for i in range(indicators.NETWORK_LITERALS + 1)]
    fill = Indicators.from_config({"cidrs": nets})
    last = len(found.networks)
    extra = tuple(n.__class__(n.label, n.order + last, n.version, n.prefix, n.number) for n in fill.networks)
    return Indicators(
        found.networks + extra,
        found.countries + tuple(pad),
        found.user_agents + tuple(pad),
        found.uris + tuple(pad),
        found.user_agent_patterns,
        found.uri_patterns,
    )


@pytest.fixture(params=["short", "long"])
def known(request):
    found = Indicators.from_config(CONFIG)
    return found if request.param == "short" else long_version(found)


CASES = [
    (("172.29.6.100", None, None, None), ["CIDR:172.29.6.0/24"]),
    (("10.0.0.1", "US", "Mozilla", "/good-path"), []),
    ((None, None, None, "/var/keyring"), ["URI_Regex:/var/keyring"]),
    ((None, None, None, "/path?query=UNION%20*%20INTO%20users"), ["URI_Regex:(?i)UNION.*INTO"]),
    ((None, None, None, "/tern-nest"), ["URI_Exact:/tern-nest"]),
    ((None, None, "nestscan/1.5", None), ["UA_Regex:(?i)nestscan"]),
    ((None, None, "Gullprobe", None), ["UA_Exact:Gullprobe"]),
    ((None, "ZW", None, None), ["Country:ZW"]),
    ((None, "zw", "gullprobe", "/TERN-NEST"), []),
    (("256.1.1.1", "", "", ""), []),
    (("010.0.0.1", None, None, None), []),
    (
        ("172.29.6.7", "ZW", "Gullprobe nestscan", "/tern-nest/var/keyring"),
        ["CIDR:172.29.6.0/24", "Country:ZW", "UA_Regex:(?i)nestscan", "URI_Regex:/var/keyring"],
    ),
    ((None, None, None, "/VAR/KEYRING"), ["URI_Regex:/var/keyring"]),
    ((None, None, None, "union\ninto"), []),
]


def test_records(spark, known):
    df = spark.createDataFrame([(i, *c[0]) for i, c in enumerate(CASES)], "i int, " + RECORD)
    got = {r["i"]: (r["matched"], r["rules"]) for r in indicators.match_all(df, known).collect()}
    assert got == {i: (bool(c[1]), c[1]) for i, c in enumerate(CASES)}
    kept = {r["i"] for r in indicators.keep_matched(df, known).collect()}
    dropped = {r["i"] for r in indicators.drop_matched(df, known).collect()}
    assert kept == {i for i, c in enumerate(CASES) if c[1]} and dropped == set(range(len(CASES))) - kept


ODD = [
    "", " ", "1.2.3", "1.2.3.4.5", "01.2.3.4", "1.2.3.4 ", "1.2.3.04", "999.1.1.1", "1.2.3.4/32", "a.b.c.d", "-1.2.3.4",
    "0.0.0.0", "255.255.255.255", "::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
    "1:2:3:4::5:6:7:8", "1::2::3", ":::", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "::ffff:1.2.3.4", "::1.2.3.4",
    "1.2.3.4::", "::1.2.3", "::01.2.3.4", "fe80::1%eth0", "fe80::1%", "fe80::1%a%b", "12345::", "g::", "1:2:3:4:5:6:1.2.3.4",
    "1:2:3:4:5:6:7:1.2.3.4", "ABCD::EF01", "2001:0db8:0000:0000:0000:ff00:0042:8329", "1:2", "%eth0", "::%1", None,
]


def random_addresses(n):
    rng = random.Random(17)
    out = []
    for _ in range(n):
        if rng.random() < 0.5:
            out.append(str(ipaddress.IPv4Address(rng.choice([rng.getrandbits(32), (10 << 24) + rng.getrandbits(20)]))))
        else:
            low = rng.choice([rng.getrandbits(64), rng.getrandbits(8)])
            address = ipaddress.IPv6Address((0x20010DB8 << 96) + (rng.getrandbits(4) << 92) + (rng.getrandbits(3) << 64) + low)
            out.append(rng.choice([str(address), address.exploded, str(address).upper()]))
    return out


def parse(text):
    try:
        return ipaddress.ip_address(text) if text else None
    except ValueError:
        return None


def test_parsing_follows_the_standard_library(spark):
    texts = ODD + random_addresses(300)
    df = spark.createDataFrame([(t,) for t in texts], "ip string")
    for r in df.select("ip", ipv4_number(F.col("ip")).alias("v4"), ipv6_hex(F.col("ip")).alias("v6")).collect():
        want = parse(r["ip"])
        if want is None:
            assert (r["v4"], r["v6"]) == (None, None), r
        elif want.version == 4:
            assert (r["v4"], r["v6"]) == (int(want), None), r
        else:
            assert (r["v4"], r["v6"]) == (None, f"{int(want):032x}"), r


def nested_networks(many):
    rng = random.Random(23)
    nets = ["10.0.0.0/8", "10.1.0.0/16", "0.0.0.0/0", "10.0.0.0/13", "10.0.0.7/32", "2001:db8::/32", "2001:db8:8000::/33",
            "::/0", "2001:db8:0:3::/64", "2001:db8:0:4::/65", "2001:db8:0:5::80/121", "ffff::/16"]
    rng.shuffle(nets)
    while len(nets) < many:
        length = rng.choice([9, 11, 14, 15, 17, 19, 22, 24, 25, 27, 30, 32])
        nets.append(str(ipaddress.ip_network(((10 << 24) + rng.getrandbits(24), length), strict=False)))
    # Wide networks last, so that order matters.
    return sorted(dict.fromkeys(nets), key=lambda n: n in ("0.0.0.0/0", "::/0"))


@pytest.mark.parametrize("many", [12, 150])
def test_first_network_in_order(spark, many):
    found = Indicators.from_config({"cidrs": nested_networks(many)})
    texts = ODD + random_addresses(400)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, ip string")
    got = indicators.match_cidr(df, "ip", found).collect()
    assert len(got) == len(texts)
    nets = [ipaddress.ip_network(n) for n in nested_networks(many)]
    for r in got:
        address = parse(r["ip"])
        hit = next((n for n in nets if address is not None and address in n), None)
        assert r["cidr_rule"] == (None if hit is None else f"CIDR:{hit}"), r


def test_tagging(spark, known):
    rows = [
        ("request_count", "172.29.6.3", "/tern-nest", "ZW", "Gullprobe", "WAF"),
        ("connection_count", "172.29.6.3", "/tern-nest", None, None, "VPC"),
        ("request_count", "8.8.8.8", "/", "US", None, None),
    ]
    df = spark.createDataFrame(rows, "metric string, key string, subkey string, country string, ua string, source_type string")
    tagged = {(r["metric"], r["key"]): r["ioc_matches"] for r in indicators.tag_findings(df, known).collect()}
    assert tagged[("request_count", "172.29.6.3")] == [
        "CIDR:172.29.6.0/24", "Country:ZW", "UA_Exact:Gullprobe", "URI_Exact:/tern-nest",
    ]
    assert tagged[("connection_count", "172.29.6.3")] == ["CIDR:172.29.6.0/24"]
    assert tagged[("request_count", "8.8.8.8")] is None
    for none in (None, Indicators()):
        assert [r["ioc_matches"] for r in indicators.tag_findings(df, none).collect()] == [None] * 3


def test_every_agent_of_a_minute_is_matched(spark):
    minute = "2024-01-01 00:00:00"
    rows = [("request_count", "1.1.1.1", "/", minute, 5.0, c, a, "WAF") for c, a in (("US", "Mozilla/5.0"), ("US", "nestscan/1.5"), ("ZW", None))]
    schema = "metric string, key string, subkey string, minute string, value double, country string, ua string, source_type string"
    details = spark.createDataFrame(rows, schema)
    findings = details.limit(1).withColumn("country", F.lit(None).cast("string")).withColumn("ua", F.lit(None).cast("string"))
    found = Indicators.from_config({"country": ["ZW"], "regex": {"ua": ["nestscan"]}})
    got = indicators.tag_findings(findings, found, details).first()
    assert got["ioc_matches"] == ["Country:ZW", "UA_Regex:nestscan"] and got["country"] in ("US", "ZW")
    assert indicators.tag_findings(findings, None, details).first()["ioc_matches"] is None


def test_loading(tmp_path):
    path = tmp_path / "ioc.yml"
    path.write_text("cidrs: ['1.2.3.4', '10.0.0.0/8']\nregex:\n  uri: ['(?i)xss']\n")
    found = load_indicators(str(path))
    assert [n.label for n in found.networks] == ["1.2.3.4/32", "10.0.0.0/8"]
    assert found.uri_patterns == ("(?i)xss",) and not found.is_empty()
    with pytest.raises(FileNotFoundError):
        load_indicators(str(tmp_path / "none.yml"))
    for bad in ({"cidrs": ["10.0.0.1/8"]}, {"regex": {"ua": ["("]}}):
        with pytest.raises(Exception):
            Indicators.from_config(bad)


def test_frequent_and_missing_values_beyond_the_bound(spark, monkeypatch):
    """Joins that may not broadcast: a third of the rows share a value, a third have none."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        ip = ["203.0.113.7", None, f"198.18.{rng.randrange(4)}.{rng.randrange(256)}", "fd00:5::" + hex(i)[2:]][rng.randrange(4)]
        uri = ["/hot", None, f"/u{rng.randrange(400)}", ""][rng.randrange(4)]
        rows.append((i, ip, uri))
    df = spark.createDataFrame(rows, "n int, client_ip string, uri string").repartition(5)
    nets = ["203.0.113.0/29", "203.0.113.0/24", "198.18.1.0/25", "198.18.0.0/15", "fd00:5::100/121", "fd00:5::/67", "fd00::/9"]
    nets += [f"10.{i}.{i}.0/{length}" for i in range(70) for length in (24, 25, 27)] + ["198.18.1.0/25"]
    found = Indicators.from_config({"cidrs": nets, "uri": ["/hot", "/hot"] + [f"/u{i}" for i in range(0, 400, 2)]})
    expected = {}
    parsed = [ipaddress.ip_network(n) for n in nets]
    for n, ip, uri in rows:
        address = ipaddress.ip_address(ip) if ip else None
        first = next((f"CIDR:{net}" for net in parsed if address is not None and address in net), None)
        expected[n] = (first, f"URI_Exact:{uri}" if uri and uri in found.uris else None)

    def got():
        out = indicators.match_uri(indicators.match_cidr(df, "client_ip", found), "uri", found)
        return {r["n"]: (r["cidr_rule"], r["uri_rule"]) for r in out.collect()}

    assert got() == expected
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr("surgelens.session.BROADCAST_BYTES", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert got() == expected
        listed = spark.createDataFrame([("/hot",), ("/hot",), (None,), ("",), ("/u4",)], "u string")
        by_table = indicators.match_uri_table(df, "uri", listed).collect()
        assert len(by_table) == len(rows)
        assert {r["uri_rule"] for r in by_table} <= {None, "URI_Exact:/hot", "URI_Exact:/u4"}
        assert all((r["uri_rule"] is not None) == (r["uri"] in ("/hot", "/u4")) for r in by_table)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_asn_ranges_match_brute_force(spark):
    import random

    rnd = random.Random(6)
    cuts = sorted(rnd.sample(range(0, 1 << 32, 256), 400)) + [(1 << 32) - 1]
    ranges, at = [], 0
    for cut in cuts:
        if rnd.random() < 0.7:
            ranges.append((at, cut - rnd.choice([0, 1, 200]) if cut - 200 > at else cut, f"AS{rnd.randint(1, 9)}"))
        at = cut + 1
    ranges += [(10, 5, "AS99")]
    numbers = [rnd.randrange(1 << 32) for _ in range(800)] + [n for a, b, _ in ranges[:200] for n in (a, b, b + 1) if n < 1 << 32]
    texts = [".".join(str(n >> s & 255) for s in (24, 16, 8, 0)) for n in numbers] + [None, "", "1.2.3", "::1", "01.2.3.4"]
    texts += texts[:1] * 1500  # one address has most rows
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, ip string, last string").repartition(4)
    table = spark.createDataFrame(ranges, "first long, last long, asn string")

    def owner(text):
        try:
            n = int(ipaddress.IPv4Address(text))
        except ValueError:
            return None
        return next((asn for a, b, asn in ranges if a <= n <= b), None)

    got = {r["id"]: r["asn"] for r in indicators.with_asn(df, "ip", table).collect()}
    assert got == {i: owner(t) if t else None for i, t in enumerate(texts)} and len(set(got.values())) > 5


def test_asn_lookup_keeps_rows_in_place(spark, monkeypatch):
    from test_plans import plan, shuffles

    df = spark.range(300).selectExpr("id", "'10.0.0.' || id % 200 AS ip")
    ranges = spark.createDataFrame([(10 << 24, (10 << 24) + 99, "AS1"), ((10 << 24) + 150, 11 << 24, "AS2")], "first long, last long, asn string")
    found = indicators.with_asn(df, "ip", ranges)
    assert shuffles(found) == 0 and "CartesianProduct" not in plan(found) and "BroadcastNestedLoopJoin" not in plan(found)
    listed = Indicators.from_config({"asn": ["AS2"], "country": ["x"]})
    assert indicators.match_asn(found, "asn", listed).where("asn_rule = 'ASN:AS2'").count() == 50
    rules = indicators.match_all(found.withColumn("c", F.lit("x")), listed, ip="ip", country="c", user_agent="c", uri="c", asn="asn")
    assert {tuple(r["rules"]) for r in rules.collect()} == {("Country:x",), ("Country:x", "ASN:AS2")}
    monkeypatch.setattr("surgelens.session.BROADCAST_BYTES", 10)
    beyond = indicators.with_asn(df, "ip", ranges)
    assert sorted(map(str, beyond.collect())) == sorted(map(str, found.collect()))


def test_bad_asn_raises():
    with pytest.raises(ValueError):
        Indicators.from_config({"asn": ["12345"]})


def mixed_networks(n, seed):
    rnd, out = random.Random(seed), []
    for order in range(n):
        version = rnd.choice([4, 4, 6])
        bits = 32 if version == 4 else 128
        prefix = rnd.choice([0, 3, 8, 9, 13, 16, 17, 20, 24, 27, 31, 32] if version == 4 else [0, 7, 32, 40, 44, 48, 63, 64, 65, 96, 127, 128])
        number = rnd.choice([10 << 24, 172 << 24]) + rnd.getrandbits(18) if version == 4 else (0x20010DB8 << 96) + (rnd.getrandbits(30) << rnd.choice([0, 40, 70]))
        net = ipaddress.ip_network((number >> (bits - prefix) << (bits - prefix), prefix))
        out.append(str(net))
    return out


def test_flat_index_matches_brute_force(spark):
    texts = mixed_networks(300, 1)
    rnd = random.Random(2)
    rows = []
    for t in texts:
        net = ipaddress.ip_network(t)
        for _ in range(3):
            rows.append(str(net[rnd.randrange(min(net.num_addresses, 1 << 60))]))
        rows += [str(net[-1]), str(net[0])]
        if int(net[0]):
            rows.append(str(net[0] - 1))
    rows += ["", None, "x", "1.2.3", "::ffff:10.0.0.1", "2001:DB8::1%eth0", "2001:db8::1%", "2001:db8::1%a%b", "10.0.0.01", " 10.0.0.1", "10.0.0.1 "]
    nets = [ipaddress.ip_network(t) for t in texts]

    def first(text):
        try:
            ip = ipaddress.ip_address(text or "")
        except ValueError:
            return None
        return next((f"CIDR:{n}" for n in nets if n.version == ip.version and ip in n), None)

    df = spark.createDataFrame(list(enumerate(rows)), "id int, ip string")
    for config in (texts, texts[:20]):
        nets = [ipaddress.ip_network(t) for t in config]
        got = {r["id"]: r["cidr_rule"] for r in indicators.match_cidr(df, "ip", Indicators.from_config({"cidrs": config})).collect()}
        assert got == {i: first(t) for i, t in enumerate(rows)}


def test_flat_index_and_joins_agree_on_many_networks(spark, monkeypatch):
    found = Indicators.from_config({"cidrs": list(dict.fromkeys(mixed_networks(100_000, 3)))})
    ids = spark.range(3000)
    four = ids.selectExpr("concat('10.', id % 4, '.', id % 251, '.', id % 17) AS ip")
    six = ids.selectExpr("concat('2001:db8::', hex(id * 7919 % 65536), ':', hex(id)) AS ip")
    df = four.union(six)
    flat = sorted(map(str, indicators.match_cidr(df, "ip", found).collect()))
    monkeypatch.setattr("surgelens.session.BROADCAST_BYTES", 1000)
    assert sorted(map(str, indicators.match_cidr(df, "ip", found).collect())) == flat
    assert sum("CIDR" in x for x in flat) > 3000


@pytest.mark.parametrize(
    "pattern,literal",
    [
        ("/etc/passwd", ["/etc/passwd"]),
        ("(?i)UNION.*SELECT", ["select"]),
        ("a(bcd)?efgh", ["efgh"]),
        ("(?:foo|barbaz)q", ["foo", "barbaz"]),
        ("(?:foo|)quiz", ["quiz"]),
        ("(login)+x", ["login"]),
        ("[ab]cde$", ["cde"]),
        ("^adm\\bin", ["admin"]),
        ("x{0,3}yz", ["yz"]),
        (".*", []),
        ("(?!secret)abc", ["abc"]),
        ("(?x) a b c d", []),
        ("é{2}naïve", ["na"]),
    ],
)
def test_required_literals(pattern, literal):
    assert P.required_literals(pattern) == literal


def test_thousands_of_patterns_match_the_ordered_scan(spark):
    import re

    rnd = random.Random(8)
    words = [f"{a}{b}{rnd.randint(0, 99)}" for a in ("admin", "shell", "scan", "probe", "etc", "bak") for b in ("er", "-x", "/p", "_", "Q", "zz")]
    shapes = ["{}", "(?i){}", "^/{}", "{}.*{}", "(?:{}|{})end", "[a-f]{}", "{}?x", "({})+/", "{}\\\\d{{2}}$"]
    patterns = []
    for i in range(5000):
        shape = rnd.choice(shapes)
        patterns.append(shape.format(*[f"{rnd.choice(words)}{i % 700}" for _ in range(shape.count("{}"))]))
    patterns = list(dict.fromkeys(patterns + ["x[0-9]y", "q"]))
    texts = []
    for _ in range(500):
        seed = re.sub(r"[\\^$?*+(){}\[\]|]|\(\?i\)|\\d", rnd.choice(["", "x", "12"]), rnd.choice(patterns))
        texts.append(rnd.choice(["/", "", "b", "pre "]) + (seed.upper() if rnd.random() < 0.4 else seed) + rnd.choice(["", "end", "/", "77"]))
    texts += ["", None, "nothing here", "b\u0130N" + words[0], "\u212aelvin"]
    compiled = [re.compile(p, re.I) for p in patterns]

    def first(text):
        return next((f"URI_Regex:{p}" for p, c in zip(patterns, compiled) if text and c.search(text)), None)

    found = Indicators.from_config({"regex": {"uri": patterns}})
    df = spark.createDataFrame(list(enumerate(texts)), "id int, uri string")
    got = {r["id"]: r["uri_regex_rule"] for r in indicators.match_uri(df, "uri", found).collect()}
    assert got == {i: first(t) for i, t in enumerate(texts)} and sum(x is not None for x in got.values()) > 100
    index = P.PatternIndex(patterns)
    tried = [len(index.candidates(t)) for t in texts if t]
    assert sum(tried) / len(tried) < 40, "most patterns are ruled out"


def test_few_and_many_patterns_agree(spark, monkeypatch):
    found = Indicators.from_config({"regex": {"uri": ["/etc/passwd", "(?i)UNION.*SELECT", "k\u0131t", "."], "ua": ["bot"]}})
    rows = ["/ETC/passwd", "/x?union all select", "\u212a\u0130T", "K\u0131t", "", None, "\n", "ſelect union select", "unionſelect"]
    df = spark.createDataFrame([(r,) for r in rows], "uri string")
    few = indicators.match_uri(df, "uri", found).collect()
    monkeypatch.setattr(indicators, "PATTERNS", 0)
    assert indicators.match_uri(df, "uri", found).collect() == few
    rules = indicators.match_all(df, found, ip="uri", country="uri", user_agent="uri", uri="uri")
    assert [r["rules"] for r in rules.collect()] == [[r["uri_regex_rule"]] if r["uri_regex_rule"] else [] for r in few]


def test_risk_weighs_rules(spark):
    config = {"country": ["KP", "RU"], "weights": {"Country": 2, "Country:KP": 5.5, "UA_Regex": 0}}
    found = Indicators.from_config(config)
    rows = [("a", 4.0, ["Country:KP", "CIDR:x"]), ("b", -9.0, ["Country:RU"]), ("c", 9.5, None), ("d", 3.0, ["UA_Regex:z"]), ("e", 3.5, ["Country:RU"])]
    df = spark.createDataFrame([(k, s, r, "m", "s", "t") for k, s, r in rows], "key string, score double, ioc_matches array<string>, metric string, subkey string, minute string")
    got = indicators.ranked_by_risk(df, found, 10).collect()
    assert [(r["key"], r["risk"]) for r in got] == [("a", 6.5), ("b", 2.0), ("e", 2.0), ("c", 0.0), ("d", 0.0)]
    plain = {r["key"]: r["risk"] for r in indicators.ranked_by_risk(df, Indicators()).collect()}
    assert plain == {"a": 2.0, "b": 1.0, "c": 0.0, "d": 1.0, "e": 1.0}
    with pytest.raises(ValueError):
        Indicators.from_config({"weights": {"CIDR": -1}})
