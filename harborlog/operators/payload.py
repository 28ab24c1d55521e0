"""Decode and re-encode Protobuf payloads.

The message type comes from a descriptor set of the caller's. Only the payload column crosses to Python, in Arrow
batches; the rest of the row stays in the JVM. The functions are declared non-deterministic so that a payload is decoded
once even if several columns or filters use the result: filter on the envelope before decoding.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from operator import attrgetter
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAILFAST = "FAILFAST"
PERMISSIVE = "PERMISSIVE"


@dataclass(frozen=True)
class MessageType:
    """A message by name in a serialized ``FileDescriptorSet``."""

    descriptor_set: bytes
    name: str

    def message_class(self) -> type:
        try:
            from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
        except ImportError as error:
            raise ImportError("decoding payloads needs the protobuf package on every executor") from error
        pool = descriptor_pool.DescriptorPool()
        for file in descriptor_pb2.FileDescriptorSet.FromString(self.descriptor_set).file:
            pool.Add(file)
        return message_factory.GetMessageClass(pool.FindMessageTypeByName(self.name))

    def spark_type(self) -> T.StructType:
        return struct_type(self.message_class().DESCRIPTOR)


def struct_type(descriptor: Any, parents: tuple[str, ...] = ()) -> T.StructType:
    """The Spark type of a message.

    Unsigned types are widened, enums are their names, and a message that contains itself is refused.
    """
    if descriptor.full_name in parents:
        raise ValueError(f"message {descriptor.full_name} contains itself")
    inside = (*parents, descriptor.full_name)
    return T.StructType(
        [T.StructField(field.name, _field_type(field, inside), True) for field in descriptor.fields]
    )


def decode(
    records: DataFrame, message: MessageType, mode: str = FAILFAST, value: str = "value"
) -> DataFrame:
    """Add ``payload``, the decoded message.

    ``FAILFAST`` fails the query at the first payload that does not parse, or is null. ``PERMISSIVE`` leaves
    ``payload`` null there and says why in ``decode_error``; see ``decoded`` and ``dead_letters``.
    """
    if mode not in (FAILFAST, PERMISSIVE):
        raise ValueError(f"unknown mode {mode!r}")
    result = _decoder(message, mode)(F.col(value))
    out = records.withColumn("_decoded", result).withColumn("payload", F.col("_decoded.payload"))
    if mode == PERMISSIVE:
        out = out.withColumn("decode_error", F.col("_decoded.error"))
    return out.drop("_decoded")


def decoded(records: DataFrame) -> DataFrame:
    """The rows of a permissive decode whose payload parsed."""
    return records.where(F.col("decode_error").isNull()).drop("decode_error")


def dead_letters(records: DataFrame) -> DataFrame:
    """The rows of a permissive decode whose payload did not parse, with the reason."""
    return records.where(F.col("decode_error").isNotNull()).drop("payload")


def reencode(message: MessageType, value: Column) -> Column:
    """Parse a payload and write it out again, fields in order of their numbers; fails if it does not parse."""

    @F.arrow_udf(T.BinaryType())
    def normalise(values: pa.Array) -> pa.Array:
        parse = message.message_class().FromString
        return pa.array(
            [parse(_present(v)).SerializeToString(deterministic=True) for v in values.to_pylist()], pa.binary()
        )

    return normalise(value)


def encode(message: MessageType, fields: dict[str, Column]) -> Column:
    """Build payloads from columns; a null leaves its field unset."""
    names = list(fields)

    @F.arrow_udf(T.BinaryType())
    def build(rows: pa.Array) -> pa.Array:
        cls = message.message_class()
        columns = [column.to_pylist() for column in rows.flatten()]
        out = []
        for row in zip(*columns):
            present = {name: value for name, value in zip(names, row) if value is not None}
            out.append(cls(**present).SerializeToString(deterministic=True))
        return pa.array(out, pa.binary())

    return build(F.struct(*[column.alias(name) for name, column in zip(names, fields.values())]))


def _decoder(message: MessageType, mode: str) -> Callable[[Column], Column]:
    payload = message.spark_type()
    schema = T.StructType(
        [T.StructField("payload", payload, True), T.StructField("error", T.StringType(), True)]
    )

    @F.arrow_udf(schema)
    def parse_batch(values: pa.Array) -> pa.Array:
        from google.protobuf.message import DecodeError
        from pyspark.sql.pandas.types import to_arrow_type

        cls = message.message_class()
        parse, blank = cls.FromString, cls()
        messages, errors = [], []
        for raw in values.to_pylist():
            try:
                messages.append(parse(_present(raw)))
                errors.append(None)
            except (DecodeError, ValueError) as failure:
                if mode == FAILFAST:
                    raise
                messages.append(blank)
                errors.append("null payload" if raw is None else type(failure).__name__)
        names = [field.name for field in cls.DESCRIPTOR.fields]
        arrays = [
            pa.array(_column_reader(field)(messages), to_arrow_type(kind.dataType))
            for field, kind in zip(cls.DESCRIPTOR.fields, payload.fields)
        ]
        failed = pa.array([error is not None for error in errors], pa.bool_())
        rows = pa.StructArray.from_arrays(arrays, names=names, mask=failed)
        return pa.StructArray.from_arrays(
            [rows, pa.array(errors, pa.string())], names=["payload", "error"]
        )

    return parse_batch.asNondeterministic()


def _present(raw: bytes | None) -> bytes:
    if raw is None:
        raise ValueError("null payload")
    return raw


def _scalar_type(field: Any) -> T.DataType:
    from google.protobuf.descriptor import FieldDescriptor as D

    by_cpp_type = {
        D.CPPTYPE_INT32: T.IntegerType(),
        D.CPPTYPE_INT64: T.LongType(),
        D.CPPTYPE_UINT32: T.LongType(),
        D.CPPTYPE_UINT64: T.DecimalType(20, 0),
        D.CPPTYPE_DOUBLE: T.DoubleType(),
        D.CPPTYPE_FLOAT: T.FloatType(),
        D.CPPTYPE_BOOL: T.BooleanType(),
        D.CPPTYPE_ENUM: T.StringType(),
        D.CPPTYPE_STRING: T.BinaryType() if field.type == D.TYPE_BYTES else T.StringType(),
    }
    return by_cpp_type[field.cpp_type]


def _is_map(field: Any) -> bool:
    return field.message_type is not None and field.message_type.GetOptions().map_entry


def _field_type(field: Any, parents: tuple[str, ...]) -> T.DataType:
    if _is_map(field):
        entry = field.message_type.fields_by_name
        return T.MapType(_field_type(entry["key"], parents), _field_type(entry["value"], parents))
    one = struct_type(field.message_type, parents) if field.message_type else _scalar_type(field)
    return T.ArrayType(one) if field.is_repeated else one


def _value_reader(field: Any) -> Callable[[Any], Any] | None:
    """How to turn one value into what Arrow takes; None if it can be taken as it is."""
    from google.protobuf.descriptor import FieldDescriptor as D

    if field.message_type is not None:
        inner = [(f.name, _column_reader(f)) for f in field.message_type.fields]
        return lambda message: {name: read([message])[0] for name, read in inner}
    if field.enum_type is not None:
        names = {number: value.name for number, value in field.enum_type.values_by_number.items()}
        return lambda number: names.get(number, str(number))
    if field.cpp_type == D.CPPTYPE_UINT64:
        from decimal import Decimal

        return Decimal
    return None


def _column_reader(field: Any) -> Callable[[list], list]:
    """How to take one field out of many messages; an unset field with presence is null."""
    name, get = field.name, attrgetter(field.name)
    if _is_map(field):
        read = _value_reader(field.message_type.fields_by_name["value"]) or (lambda value: value)
        return lambda messages: [[(key, read(value)) for key, value in get(m).items()] for m in messages]
    read = _value_reader(field)
    if field.is_repeated:
        if read is None:
            return lambda messages: [list(get(m)) for m in messages]
        return lambda messages: [[read(item) for item in get(m)] for m in messages]
    if field.has_presence:
        if read is None:
            return lambda messages: [get(m) if m.HasField(name) else None for m in messages]
        return lambda messages: [read(get(m)) if m.HasField(name) else None for m in messages]
    if read is None:
        return lambda messages: [get(m) for m in messages]
    return lambda messages: [read(get(m)) for m in messages]
