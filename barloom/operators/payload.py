"""JSON bodies to typed rows, with built-in expressions only.

Bodies are read by a declared schema, so keys are matched whole: a key that begins like another one
cannot disturb it, unknown keys are ignored and missing ones are null. Whole numbers are accepted
for doubles, and numbers written with a zero fraction for integers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from barloom.functions.naming import snake_map

_WHOLE = (T.IntegerType, T.LongType)
_READ_WHOLE = T.DecimalType(38, 6)


def _read_as(kind: T.DataType) -> T.DataType:
    """Doubles hold every 32-bit integer and are read faster than decimals."""
    if isinstance(kind, T.IntegerType):
        return T.DoubleType()
    return _READ_WHOLE if isinstance(kind, T.LongType) else kind


def _reading(schema: T.StructType) -> T.StructType:
    """The schema to parse by: integers are read as decimals, so that 12.0 survives."""
    return T.StructType([
        T.StructField(f.name, _read_as(f.dataType))
        for f in schema
    ])


def _fields(struct: str, schema: T.StructType) -> list[Column]:
    names = snake_map(schema.names)
    columns = []
    for f in schema:
        value = F.col(struct)[f.name]
        if isinstance(f.dataType, _WHOLE):
            value = F.when(value == F.floor(value), value.try_cast(f.dataType))
        columns.append(value.alias(names[f.name]))
    return columns


def decode_object(df: DataFrame, schema: T.StructType, keep: Sequence[str] = (),
                  body: str = "body") -> DataFrame:
    """One row per object body: ``keep`` and the schema's fields in snake_case."""
    parsed = df.select(*keep, F.from_json(body, _reading(schema)).alias("_o"))
    return parsed.select(*keep, *_fields("_o", schema))


def decode_array(df: DataFrame, schema: T.StructType, keep: Sequence[str] = (),
                 body: str = "body", outer: bool = False) -> DataFrame:
    """One row per element of an array body.

    With ``outer`` an empty or unreadable body gives one row that has only ``keep``.
    """
    explode = F.explode_outer if outer else F.explode
    rows = F.from_json(body, T.ArrayType(_reading(schema)))
    return df.select(*keep, explode(rows).alias("_o")).select(*keep, *_fields("_o", schema))


def decode_wrapped(df: DataFrame, schema: T.StructType, header: T.StructType | None = None,
                   keep: Sequence[str] = (), body: str = "body",
                   rows: str = "data") -> DataFrame:
    """One row per element of the array inside an object, with the object's own header fields."""
    header = header or T.StructType([T.StructField("ticker", T.StringType())])
    whole = _reading(header).add(rows, T.ArrayType(_reading(schema)))
    parsed = df.select(*keep, F.from_json(body, whole).alias("_w"))
    exploded = parsed.select(*keep, "_w", F.explode(F.col("_w")[rows]).alias("_o"))
    return exploded.select(*keep, *_fields("_w", header), *_fields("_o", schema))


PARSED = "parsed"


def parsed_type(kind: str, schema: T.StructType, header: T.StructType | None = None,
                rows: str = "data") -> T.DataType:
    """What a body of a kind ("object", "array" or "wrapped") is parsed into."""
    if kind == "wrapped":
        header = header or T.StructType([T.StructField("ticker", T.StringType())])
        return T.StructType(_reading(header).fields + [T.StructField(rows, T.ArrayType(_reading(schema)))])
    return T.ArrayType(_reading(schema)) if kind == "array" else _reading(schema)


def parse_once(df: DataFrame, kind: str, schema: T.StructType, header: T.StructType | None = None,
               body: str = "body") -> DataFrame:
    """``df`` with ``parsed``, and the body itself only where it cannot be read as its kind.

    One parse tells both: the body is read as the only element of an array, so text after its end, an
    unfinished body and one of another form all leave no single element. A value of another type than
    its field is null by itself.
    """
    whole = F.from_json(F.concat(F.lit("["), body, F.lit("]")), T.ArrayType(parsed_type(kind, schema, header)))
    opening = r"^\s*\[" if kind == "array" else r"^\s*\{"
    one = F.when((F.size("_whole") == 1) & F.col(body).rlike(opening), F.col("_whole")[0])
    others = [c for c in df.columns if c != body]
    return df.select(*others, body, whole.alias("_whole")).select(
        *others, body, one.alias(PARSED)).select(
        *others, F.when(F.col(PARSED).isNull(), F.col(body)).alias(body), PARSED)


def unreadable(df: DataFrame, kind: str, schema: T.StructType, header: T.StructType | None = None,
               body: str = "body") -> DataFrame:
    """The rows of ``df`` whose body :func:`parse_once` cannot read. A condition on what it has parsed would be moved to
    the scan and parse twice; here an element of an array holds what one parse gives."""
    whole = F.from_json(F.concat(F.lit("["), body, F.lit("]")), T.ArrayType(parsed_type(kind, schema, header)))
    opening = r"^\s*\[" if kind == "array" else r"^\s*\{"
    one = F.exists(F.array(whole), lambda w: F.coalesce((F.size(w) == 1) & w[0].isNotNull(), F.lit(False)))
    return df.filter(~(F.coalesce(F.col(body).rlike(opening), F.lit(False)) & one))


def rows_of(df: DataFrame, kind: str, schema: T.StructType, header: T.StructType | None = None,
            keep: Sequence[str] = (), rows: str = "data", outer: bool = False) -> DataFrame:
    """The rows of bodies that :func:`parse_once` has read: ``keep``, header and fields in snake_case.

    With ``outer`` a body that could not be read gives one row that has only ``keep``.
    """
    keep = list(keep)
    if kind == "object":
        return (df if outer else df.filter(F.col(PARSED).isNotNull())).select(*keep, *_fields(PARSED, schema))
    held = F.col(PARSED) if kind == "array" else F.col(PARSED)[rows]
    if outer:       # an element of null stands for the body itself
        unread = F.col(PARSED).isNull()
        nothing = F.array(F.lit(None).cast(_reading(schema)))
        held = F.when(unread, nothing).otherwise(held)
    exploded = df.select(*keep, PARSED, F.explode(held).alias("_o"))
    if kind == "array":
        return exploded.select(*keep, *_fields("_o", schema))
    header = header or T.StructType([T.StructField("ticker", T.StringType())])
    return exploded.select(*keep, *_fields(PARSED, header), *_fields("_o", schema))


def payload_types(bodies: DataFrame, schema: T.StructType, body: str = "body") -> DataFrame:
    """The keys whose sent type does not fit the table's: ``key, sent, declared, bodies``.

    ``sent`` is the least type that holds every value of the key in all bodies, of objects and of elements of
    arrays, which Spark joins along its own type lattice; ``declared`` is null for a key that the schema
    lacks. Whole numbers fit doubles, and so do decimals, and nothing but nulls fits every type.
    """
    text = F.trim(body)
    one = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    elements = bodies.select(F.explode(F.try_variant_get(F.try_parse_json(one), "$", "array<variant>")).alias("e"))
    pairs = elements.select(F.explode(F.try_variant_get("e", "$", "map<string, variant>")).alias("key", "value"))
    sent = pairs.groupBy("key").agg(F.schema_of_variant_agg("value").alias("sent"), F.count(F.lit(1)).alias("values"))
    spark = bodies.sparkSession
    declared = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema], "key string, declared string")
    number = F.col("sent").startswith("DECIMAL") | F.col("sent").isin("BIGINT", "DOUBLE", "FLOAT")
    fits = (F.col("sent") == "VOID") | F.when(F.col("declared") == "double", number) \
        .when(F.col("declared").isin("bigint", "int"), F.col("sent") == "BIGINT") \
        .when(F.col("declared") == "string", F.col("sent") == "STRING") \
        .otherwise(F.col("sent") == F.upper("declared"))
    return sent.join(F.broadcast(declared), "key", "left").filter(~F.coalesce(fits, F.lit(False))).select(
        "key", F.regexp_replace("sent", r"\(.*\)", "").alias("sent"), "declared", "values")


def is_readable(kind: str, body: str = "body") -> Column:
    """True for well-formed JSON whose outermost form is the expected one; never null.

    As the only element of an array, so that text after the first value is noticed too.
    """
    opening = r"^\s*\[" if kind == "array" else r"^\s*\{"
    text = F.col(body)
    elements = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    return F.coalesce(text.rlike(opening) & (elements == 1), F.lit(False))


def quarantine(df: DataFrame, kind: str, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Readable bodies, and the others to be kept aside."""
    readable = is_readable(kind, body)
    return df.filter(readable), df.filter(~readable)


def tickers_of_master_list(df: DataFrame, schema: T.StructType, body: str = "body") -> DataFrame:
    """The ticker universe from master-list bodies (``{"items": [{"ticker": …}]}``)."""
    items = F.explode(F.from_json(body, schema)["items"])
    return df.select(items.alias("_i")).select(F.col("_i.ticker").alias("ticker")).distinct()
