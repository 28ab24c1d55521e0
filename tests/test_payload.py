from decimal import Decimal

import pytest
from google.protobuf import descriptor_pb2 as pb
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlog.operators import FAILFAST, PERMISSIVE, MessageType, dead_letters, decode, decoded, encode, reencode
from harborlog.operators.payload import struct_type
from harborlog.functions import by_payload_field
from workload.fixtures import message as event_message

K = pb.FieldDescriptorProto


def all_kinds(syntax="proto2") -> MessageType:
    file = pb.FileDescriptorProto(name=f"kinds_{syntax}.proto", package="kinds", syntax=syntax)
    colour = file.enum_type.add(name="Colour")
    colour.value.add(name="RED", number=0)
    colour.value.add(name="BLUE", number=5)
    inner = file.message_type.add(name="Inner")
    inner.field.add(name="n", number=1, type=K.TYPE_INT32, label=K.LABEL_OPTIONAL)
    outer = file.message_type.add(name="Outer")
    kinds = [
        ("i32", K.TYPE_INT32), ("i64", K.TYPE_INT64), ("u32", K.TYPE_UINT32), ("u64", K.TYPE_UINT64),
        ("s64", K.TYPE_SINT64), ("f32", K.TYPE_FLOAT), ("f64", K.TYPE_DOUBLE), ("flag", K.TYPE_BOOL),
        ("text", K.TYPE_STRING), ("raw", K.TYPE_BYTES),
    ]
    for number, (name, kind) in enumerate(kinds, start=1):
        outer.field.add(name=name, number=number, type=kind, label=K.LABEL_OPTIONAL)
    outer.field.add(name="colour", number=20, type=K.TYPE_ENUM, type_name=".kinds.Colour", label=K.LABEL_OPTIONAL)
    outer.field.add(name="inner", number=21, type=K.TYPE_MESSAGE, type_name=".kinds.Inner", label=K.LABEL_OPTIONAL)
    outer.field.add(name="many", number=22, type=K.TYPE_MESSAGE, type_name=".kinds.Inner", label=K.LABEL_REPEATED)
    entry = outer.nested_type.add(name="CountsEntry")
    entry.options.map_entry = True
    entry.field.add(name="key", number=1, type=K.TYPE_STRING, label=K.LABEL_OPTIONAL)
    entry.field.add(name="value", number=2, type=K.TYPE_UINT64, label=K.LABEL_OPTIONAL)
    outer.field.add(
        name="counts", number=23, type=K.TYPE_MESSAGE, type_name=".kinds.Outer.CountsEntry", label=K.LABEL_REPEATED
    )
    return MessageType(pb.FileDescriptorSet(file=[file]).SerializeToString(), "kinds.Outer")


def one(spark, message, raw, mode=FAILFAST):
    frame = spark.createDataFrame([(bytearray(raw) if raw is not None else None,)], "value binary")
    return decode(frame, message, mode)


def test_types():
    fields = {field.name: field.dataType for field in all_kinds().spark_type().fields}
    assert fields["u32"] == T.LongType() and fields["u64"] == T.DecimalType(20, 0)
    assert fields["raw"] == T.BinaryType() and fields["colour"] == T.StringType()
    assert fields["many"] == T.ArrayType(T.StructType([T.StructField("n", T.IntegerType())]))
    assert fields["counts"] == T.MapType(T.StringType(), T.DecimalType(20, 0))


def test_every_kind_of_field(spark):
    message = all_kinds()
    cls = message.message_class()
    value = cls(
        i32=-1, i64=1 << 40, u32=(1 << 32) - 1, u64=(1 << 64) - 1, s64=-9, f32=0.5, f64=0.25, flag=True, text="é",
        raw=b"\x00\xff", colour=5, inner={"n": 7}, many=[{"n": 1}, {}], counts={"a": (1 << 63)},
    )
    row = one(spark, message, value.SerializeToString()).first().payload
    assert (row.i32, row.i64, row.u32, row.u64, row.s64) == (-1, 1 << 40, (1 << 32) - 1, Decimal((1 << 64) - 1), -9)
    assert (row.f32, row.f64, row.flag, row.text, bytes(row.raw)) == (0.5, 0.25, True, "é", b"\x00\xff")
    assert row.colour == "BLUE" and row.inner.n == 7 and [item.n for item in row.many] == [1, None]
    assert row.counts == {"a": Decimal(1 << 63)}


def test_unset_is_null_and_empty_is_not(spark):
    message = all_kinds()
    row = one(spark, message, b"").first().payload
    assert row.text is None and row.inner is None and row.colour is None and row.many == [] and row.counts == {}
    assert one(spark, message, message.message_class()(text="").SerializeToString()).first().payload.text == ""


def test_fields_without_presence_have_defaults(spark):
    row = one(spark, all_kinds("proto3"), b"").first().payload
    assert (row.i32, row.text, row.colour, row.inner) == (0, "", "RED", None)


def test_message_that_contains_itself_is_refused():
    file = pb.FileDescriptorProto(name="loop.proto", package="loop", syntax="proto2")
    node = file.message_type.add(name="Node")
    node.field.add(name="next", number=1, type=K.TYPE_MESSAGE, type_name=".loop.Node", label=K.LABEL_OPTIONAL)
    message = MessageType(pb.FileDescriptorSet(file=[file]).SerializeToString(), "loop.Node")
    with pytest.raises(ValueError):
        struct_type(message.message_class().DESCRIPTOR)


@pytest.mark.parametrize("raw", [b"\x0a\xff", None])
def test_bad_payloads(spark, raw):
    with pytest.raises(Exception):
        one(spark, event_message(), raw).collect()
    rows = one(spark, event_message(), raw, PERMISSIVE)
    assert decoded(rows).isEmpty()
    assert dead_letters(rows).first().decode_error
    assert rows.select(by_payload_field()(rows)).first()[0] == "unknown"


def test_decodes_once(spark):
    frame = spark.range(3).select(encode(event_message(), {"event_id": F.col("id")}).alias("value"))
    rows = decoded(decode(frame, event_message(), PERMISSIVE)).select("payload.event_id", "payload.protocol")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parse_batch(") == 1


def test_reencode(spark):
    message = event_message()
    # Fields out of order, and one unknown to the message.
    raw = b"\x10\x05" + b"\x0a\x01p"
    frame = spark.createDataFrame([(bytearray(raw),)], "value binary")
    again = bytes(frame.select(reencode(message, F.col("value")).alias("v")).first().v)
    assert again == b"\x0a\x01p\x10\x05"
    with pytest.raises(Exception):
        spark.createDataFrame([(bytearray(b"\x0a\xff"),)], "value binary").select(
            reencode(message, F.col("value"))
        ).collect()


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        one(spark, event_message(), b"", "DROP")
