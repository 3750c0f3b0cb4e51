"""Scans of the web-request (WAF) and network-flow (VPC) log tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType, VariantType

from surgelens.sources.schemas import CORRUPT, UNKNOWN, VPC, WAF

FIELDS_OF, ITEMS_OF = "map<string,variant>", "array<variant>"


def _scan(spark: SparkSession, path: str, schema: StructType, fmt: str, keep_corrupt: bool) -> DataFrame:
    if fmt != "json":
        return spark.read.format(fmt).schema(schema).load(path)
    if keep_corrupt:
        schema = StructType(list(schema.fields)).add(CORRUPT, StringType())
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def _holds_records(kind: DataType) -> bool:
    return isinstance(kind, StructType) or (isinstance(kind, ArrayType) and _holds_records(kind.elementType))


def _object(nested: Column) -> Column:
    return F.call_function("to_variant_object", nested)


def _object_if(nested: Column, holds) -> Column:
    """The nested value as a VARIANT if ``holds`` says so, else NULL; worked out once."""
    return F.get(F.transform(F.filter(F.array(nested), holds), _object), 0)


def unknown_fields(value: Column, kind: DataType) -> Column:
    """What a VARIANT holds beyond the fields of ``kind``, nested as it came; NULL if
    nothing. A list with such elements has NULL in the place of the others."""
    if isinstance(kind, ArrayType):
        parts = F.transform(F.try_variant_get(value, "$", ITEMS_OF), lambda x: unknown_fields(x, kind.elementType))
        return _object_if(parts, lambda items: F.exists(items, lambda x: x.isNotNull()))
    found = F.map_filter(F.try_variant_get(value, "$", FIELDS_OF), lambda name, _: ~name.isin(kind.fieldNames()))
    part = lambda name: F.try_variant_get(value, f"$['{name}']", "variant")
    inner = [(f.name, unknown_fields(part(f.name), f.dataType)) for f in kind.fields if _holds_records(f.dataType)]
    if inner:
        pairs = [part for name, rest in inner for part in (F.lit(name), rest)]
        found = F.map_concat(found, F.map_filter(F.create_map(*pairs), lambda _, rest: rest.isNotNull()))
    return _object_if(found, lambda names: F.size(names) > 0)


def _whole(value: Column, rest: Column, kind: DataType) -> Column:
    """A typed value and its unknown fields as one VARIANT."""
    if isinstance(kind, ArrayType) and _holds_records(kind):
        extra = F.try_variant_get(rest, "$", ITEMS_OF)
        extra = F.coalesce(extra, F.transform(value, lambda _: F.lit(None).cast("variant")))
        return F.when(value.isNotNull(), _object(F.zip_with(value, extra, lambda v, r: _whole(v, r, kind.elementType))))
    if not isinstance(kind, StructType):
        return _object(value) if isinstance(kind, ArrayType) else value.cast("variant")
    more = F.try_variant_get(rest, "$", FIELDS_OF)
    # By its path: a look into ``more`` would take all fields apart again for each one.
    inner = lambda name: F.try_variant_get(rest, f"$['{name}']", "variant")
    pairs = [part for f in kind.fields for part in (F.lit(f.name), _whole(value[f.name], inner(f.name), f.dataType))]
    known = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    added = F.map_filter(more, lambda name, _: ~name.isin(kind.fieldNames()))
    added = F.coalesce(added, F.create_map().cast(FIELDS_OF))
    return F.when(value.isNotNull() | more.isNotNull(), _object(F.map_concat(known, added)))


def whole_record(rows: DataFrame) -> Column:
    """The record as it was logged, as a VARIANT: known fields that aren't null, under
    their merged names, and unknown ones (``keep_unknown=True``)."""
    kind = StructType([f for f in rows.schema.fields if f.name not in (UNKNOWN, CORRUPT, "dt", "hr")])
    value = F.struct(*[F.col(f"`{n}`").alias(n) for n in kind.fieldNames()])
    return F.when(F.col(CORRUPT).isNull(), _whole(value, F.col(UNKNOWN), kind))


def _whole_scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Records with what their schema lacks. Lines are read as text and parsed twice.

    The whole line goes to the corrupt column if it is no record, has a known field of
    another type, or a field twice, so nothing of any line is lost.
    """
    kind = StructType([f for f in schema.fields if f.name not in ("dt", "hr")])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    with_text = StructType(list(kind.fields)).add(CORRUPT, StringType())
    lines = spark.read.schema("value string, dt string, hr string").text(path).where(F.trim("value") != "")
    parsed = lines.select(
        "value", "dt", "hr", F.from_json("value", with_text, options).alias("r"), F.try_parse_json("value").alias("v")
    )
    # A column of its own, or every field of the result would ask again.
    parsed = parsed.withColumn("whole", F.try_variant_get("v", "$", FIELDS_OF).isNotNull() & F.col(f"r.{CORRUPT}").isNull())
    whole = F.col("whole")
    return parsed.select(
        *[F.when(whole, F.col(f"r.`{n}`")).alias(n) for n in kind.fieldNames()],
        "dt",
        "hr",
        F.when(whole, unknown_fields(F.col("v"), kind)).alias(UNKNOWN),
        F.when(whole, F.lit(None).cast("string")).otherwise(F.col("value")).alias(CORRUPT),
    )


def canonical_waf(raw: DataFrame) -> DataFrame:
    """Merge the alternate spellings of request method and response status."""
    request, response = F.col("httpRequest"), F.col("httpResponse")
    merged_request = request.withField(
        "httpMethod", F.coalesce(request["httpMethod"], request["method"])
    ).dropFields("method")
    merged_response = F.when(
        response.isNotNull(),
        F.struct(
            F.coalesce(response["status"], response["statusCode"]).alias("status"),
            F.coalesce(response["responseCodeSent"], response["responsecode_sent"]).alias("responseCodeSent"),
        ),
    )
    return raw.withColumns({"httpRequest": merged_request, "httpResponse": merged_response})


def canonical_vpc(raw: DataFrame) -> DataFrame:
    """Merge dashed field names into their underscored twins."""
    present = set(raw.columns)
    out: list[Column] = []
    for name in raw.columns:
        if "-" in name:
            continue
        dashed = name.replace("_", "-")
        if dashed != name and dashed in present:
            out.append(F.coalesce(F.col(name), F.col(f"`{dashed}`")).alias(name))
        else:
            out.append(F.col(name))
    return raw.select(*out)


def _stored(schema: StructType, keep_unknown: bool) -> StructType:
    """The columns of converted files."""
    return StructType(list(schema.fields)).add(UNKNOWN, VariantType()).add(CORRUPT, StringType()) if keep_unknown else schema


def read_waf(
    spark: SparkSession, path: str, fmt: str = "json", keep_corrupt: bool = False, keep_unknown: bool = False
) -> DataFrame:
    """Web-request logs below ``path``, partitioned as ``dt=/hr=``.

    Converted files (``fmt="parquet"``) already hold the merged columns.
    ``keep_unknown`` adds a VARIANT column of the fields that the schema lacks, and
    the corrupt column, and conversion keeps both; ``whole_record`` puts a record
    together again.
    """
    if fmt == "json" and keep_unknown:
        return canonical_waf(_whole_scan(spark, path, WAF))
    if fmt == "json":
        return canonical_waf(_scan(spark, path, WAF, fmt, keep_corrupt))
    return _scan(spark, path, _stored(canonical_waf(empty(spark, WAF)).schema, keep_unknown), fmt, False)


def read_vpc(
    spark: SparkSession, path: str, fmt: str = "json", keep_corrupt: bool = False, keep_unknown: bool = False
) -> DataFrame:
    """Network-flow logs below ``path``; short layouts read missing fields as NULL."""
    if fmt == "json" and keep_unknown:
        return canonical_vpc(_whole_scan(spark, path, VPC))
    if fmt == "json":
        return canonical_vpc(_scan(spark, path, VPC, fmt, keep_corrupt))
    return _scan(spark, path, _stored(canonical_vpc(empty(spark, VPC)).schema, keep_unknown), fmt, False)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _parsed(logs: DataFrame) -> Column:
    """Always true, but reads a data column: the parser fills the corrupt text
    only while it reads other fields, and a scan of that text alone is refused."""
    seen = F.xxhash64(F.col(logs.columns[0]))
    return seen != F.bitwise_not(seen)


def quarantined(logs: DataFrame) -> DataFrame:
    """Lines that were not valid records (read with ``keep_corrupt=True``)."""
    return logs.where(F.col(CORRUPT).isNotNull() & _parsed(logs))


def well_formed(logs: DataFrame) -> DataFrame:
    return logs.where(F.col(CORRUPT).isNull() & _parsed(logs)).drop(CORRUPT)
