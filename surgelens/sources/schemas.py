"""Read schemas of the two security-log tables.

JSON field names are matched case-sensitively, so fields carry the spelling the
logs use. Where writers differ, both spellings are read and merged afterwards.
Partition keys are strings, so that ``hr`` keeps its leading zero.

Fixed values: field names are those of the public log formats.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

CORRUPT = "_corrupt_record"
UNKNOWN = "unknown_fields"

STRING, INT, LONG, DOUBLE, TIME = StringType(), IntegerType(), LongType(), DoubleType(), TimestampType()


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(n, t) for n, t in fields.items()])


WAF = _struct(
    timestamp=LONG,
    formatVersion=INT,
    webaclId=STRING,
    terminatingRule=_struct(
        ruleId=STRING,
        action=STRING,
        ruleMatchDetails=ArrayType(_struct(conditionType=STRING, location=STRING, matchedData=ArrayType(STRING))),
    ),
    httpRequest=_struct(
        clientIp=STRING,
        country=STRING,
        headers=ArrayType(_struct(name=STRING, value=STRING)),
        uri=STRING,
        args=STRING,
        httpVersion=STRING,
        httpMethod=STRING,
        method=STRING,
        requestId=STRING,
    ),
    httpResponse=_struct(status=INT, statusCode=INT, responseCodeSent=INT, responsecode_sent=INT),
    labels=ArrayType(_struct(name=STRING)),
    dt=STRING,
    hr=STRING,
)

_FLOW_FIELDS: dict[str, DataType] = {
    "version": INT,
    "account_id": STRING,
    "interface_id": STRING,
    "srcaddr": STRING,
    "dstaddr": STRING,
    "srcport": INT,
    "dstport": INT,
    "protocol": LONG,
    "packets": LONG,
    "bytes": LONG,
    "start": LONG,
    "end": LONG,
    "action": STRING,
    "log_status": STRING,
    "vpc_id": STRING,
    "subnet_id": STRING,
    "instance_id": STRING,
    "tcp_flags": INT,
    "type": STRING,
    "pkt_srcaddr": STRING,
    "pkt_dstaddr": STRING,
    "region": STRING,
    "az_id": STRING,
    "sublocation_type": STRING,
    "sublocation_id": STRING,
    "pkt_src_aws_service": STRING,
    "pkt_dst_aws_service": STRING,
    "flow_direction": STRING,
    "traffic_path": ArrayType(INT),
}


def _both_spellings(fields: dict[str, DataType]) -> dict[str, DataType]:
    out: dict[str, DataType] = {}
    for name, kind in fields.items():
        out[name] = kind
        out[name.replace("_", "-")] = kind
    return out


VPC = _struct(**_both_spellings(_FLOW_FIELDS), dt=STRING, hr=STRING)

BASELINE = _struct(
    metric=STRING,
    key=STRING,
    subkey=STRING,
    mean=DOUBLE,
    std=DOUBLE,
    n=LONG,
    c=DOUBLE,
    q=DOUBLE,
    last_minute=TIME,
    last_updated=TIME,
    run_id=STRING,
)

FINDING = _struct(
    metric=STRING,
    key=STRING,
    subkey=STRING,
    minute=TIME,
    value=DOUBLE,
    score=DOUBLE,
    baseline_mean=DOUBLE,
    baseline_std=DOUBLE,
    country=STRING,
    ua=STRING,
    source_type=STRING,
    mode=STRING,
    ioc_matches=ArrayType(STRING),
    run_id=STRING,
    dt=STRING,
)
