"""Realtime feed messages (protobuf) to flat rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctualis.schemas import TRIP_UPDATES, VEHICLE_POSITIONS
from punctualis.sources import wire
from punctualis.sources.gtfs_static import fields_of

# The subset of the public realtime message format that is decoded,
# as message -> field -> (number, type, label). Enumerations travel as integers.
MESSAGES = {
    "FeedHeader": {"gtfs_realtime_version": (1, "string", "required"), "incrementality": (2, "int32", "optional"), "timestamp": (3, "uint64", "optional")},
    "TripDescriptor": {
        "trip_id": (1, "string", "optional"), "start_time": (2, "string", "optional"), "start_date": (3, "string", "optional"),
        "schedule_relationship": (4, "int32", "optional"), "route_id": (5, "string", "optional"), "direction_id": (6, "uint32", "optional"),
    },
    "VehicleDescriptor": {"id": (1, "string", "optional"), "label": (2, "string", "optional"), "license_plate": (3, "string", "optional")},
    "StopTimeEvent": {"delay": (1, "int32", "optional"), "time": (2, "int64", "optional"), "uncertainty": (3, "int32", "optional")},
    "StopTimeUpdate": {
        "stop_sequence": (1, "uint32", "optional"), "arrival": (2, "StopTimeEvent", "optional"), "departure": (3, "StopTimeEvent", "optional"),
        "stop_id": (4, "string", "optional"), "schedule_relationship": (5, "int32", "optional"),
    },
    "TripUpdate": {
        "trip": (1, "TripDescriptor", "required"), "stop_time_update": (2, "StopTimeUpdate", "repeated"),
        "vehicle": (3, "VehicleDescriptor", "optional"), "timestamp": (4, "uint64", "optional"), "delay": (5, "int32", "optional"),
    },
    "Position": {
        "latitude": (1, "float", "required"), "longitude": (2, "float", "required"), "bearing": (3, "float", "optional"),
        "odometer": (4, "double", "optional"), "speed": (5, "float", "optional"),
    },
    "VehiclePosition": {
        "trip": (1, "TripDescriptor", "optional"), "position": (2, "Position", "optional"), "current_stop_sequence": (3, "uint32", "optional"),
        "current_status": (4, "int32", "optional"), "timestamp": (5, "uint64", "optional"), "congestion_level": (6, "int32", "optional"),
        "stop_id": (7, "string", "optional"), "vehicle": (8, "VehicleDescriptor", "optional"), "occupancy_status": (9, "int32", "optional"),
        "occupancy_percentage": (10, "uint32", "optional"),
    },
    "FeedEntity": {
        "id": (1, "string", "required"), "is_deleted": (2, "bool", "optional"), "trip_update": (3, "TripUpdate", "optional"),
        "vehicle": (4, "VehiclePosition", "optional"),
    },
    "FeedMessage": {"header": (1, "FeedHeader", "required"), "entity": (2, "FeedEntity", "repeated")},
}

RUN_BYTES = 1 << 18  # messages decoded together

# where each flat column of a vehicle row comes from; the other columns are always NULL
VEHICLE_PATHS = {
    "bearing": "position", "latitude": "position", "longitude": "position", "odometer": "position", "speed": "position",
    "direction_id": "trip", "route_id": "trip", "schedule_relationship": "trip", "start_date": "trip", "start_time": "trip", "trip_id": "trip",
    "id": "vehicle", "label": "vehicle", "license_plate": "vehicle",
    "congestion_level": "", "current_status": "", "current_stop_sequence": "", "occupancy_percentage": "", "occupancy_status": "",
    "stop_id": "", "timestamp": "",
}


def message_factory():
    """Function that builds the feed message class, for writing messages; self-contained, so it can run inside a task."""
    messages = MESSAGES

    def build():
        from google.protobuf import descriptor_pb2, descriptor_pool
        from google.protobuf import message_factory as factory

        proto = descriptor_pb2.FieldDescriptorProto
        file = descriptor_pb2.FileDescriptorProto(name="realtime_subset.proto", package="rt", syntax="proto2")
        for name, fields in messages.items():
            message = file.message_type.add(name=name)
            for field, (number, kind, label) in fields.items():
                slot = message.field.add(name=field, number=number, label=getattr(proto, "LABEL_" + label.upper()))
                if kind in messages:
                    slot.type, slot.type_name = proto.TYPE_MESSAGE, f".rt.{kind}"
                else:
                    slot.type = getattr(proto, "TYPE_" + kind.upper())
        pool = descriptor_pool.DescriptorPool()
        pool.Add(file)
        return factory.GetMessageClass(pool.FindMessageTypeByName("rt.FeedMessage"))

    return build


def _children(data: np.ndarray, found: wire.Fields, owner: np.ndarray, number: int, bad: np.ndarray, root: np.ndarray) -> tuple[wire.Fields, np.ndarray]:
    """Fields of the messages under one field number and the owner of each such message; unreadable ones mark their feed.

    A repeated single message is merged with the earlier ones, since all of them keep one owner.
    """
    spans = found.which(number, wire.BYTES)
    inner, broken = wire.fields(data, found.start[spans], found.stop[spans])
    mine = owner[found.message[spans]]
    bad[root[mine[broken]]] = True
    return inner, mine


def _number(message: str, field: str) -> int:
    return MESSAGES[message][field][0]


def _column(data: np.ndarray, found: wire.Fields, owner: np.ndarray, count: int, message: str, field: str) -> pa.Array:
    number, kind, _ = MESSAGES[message][field]
    return wire.column(data, found, owner, count, number, kind)


def _entities(data: np.ndarray, offsets: np.ndarray) -> tuple[wire.Fields, np.ndarray, np.ndarray]:
    """Fields of all entities of the feeds, the feed of each entity, and the feeds that can't be read."""
    found, bad = wire.fields(data, offsets[:-1], offsets[1:])
    entities, feed = _children(data, found, np.arange(len(bad)), _number("FeedMessage", "entity"), bad, np.arange(len(bad)))
    return entities, feed, bad


def _trip_update_rows(data: np.ndarray, offsets: np.ndarray, absent_time_as_zero: bool) -> tuple[dict[str, pa.Array], np.ndarray, np.ndarray]:
    entities, feed, bad = _entities(data, offsets)
    count = len(feed)
    updates, entity = _children(data, entities, np.arange(count), _number("FeedEntity", "trip_update"), bad, feed)
    trips, trip_entity = _children(data, updates, entity, _number("TripUpdate", "trip"), bad, feed)
    trip_id = _column(data, trips, trip_entity, count, "TripDescriptor", "trip_id")
    # every stop time update is an owner of its own
    spans = updates.which(_number("TripUpdate", "stop_time_update"), wire.BYTES)
    stops, broken = wire.fields(data, updates.start[spans], updates.stop[spans])
    stop_entity = entity[updates.message[spans]]
    root = feed[stop_entity]
    bad[root[broken]] = True
    own = np.arange(len(root))
    columns = {"trip_id": trip_id.take(pa.array(stop_entity))}
    for name in ("stop_id", "stop_sequence", "schedule_relationship"):
        columns[name] = _column(data, stops, own, len(own), "StopTimeUpdate", name)
    for name in ("arrival", "departure"):
        events, stop = _children(data, stops, own, _number("StopTimeUpdate", name), bad, root)
        moment = _column(data, events, stop, len(own), "StopTimeEvent", "time")
        if absent_time_as_zero:
            present = np.zeros(len(own), bool)
            present[stop] = True
            moment = pc.if_else(pa.array(present), pc.fill_null(moment, 0), moment)
        columns[name] = moment
    return columns, root, bad


def _vehicle_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, pa.Array], np.ndarray, np.ndarray]:
    entities, feed, bad = _entities(data, offsets)
    found, entity = _children(data, entities, np.arange(len(feed)), _number("FeedEntity", "vehicle"), bad, feed)
    with_vehicle, owner = np.unique(entity, return_inverse=True)
    root = feed[with_vehicle]
    messages = {"": ("VehiclePosition", found, owner)}
    for parent in sorted(set(VEHICLE_PATHS.values()) - {""}):
        number, kind, _ = MESSAGES["VehiclePosition"][parent]
        messages[parent] = (kind, *_children(data, found, owner, number, bad, root))
    columns = {}
    for name, parent in VEHICLE_PATHS.items():
        kind, inner, mine = messages[parent]
        columns[name] = _column(data, inner, mine, len(root), kind, name)
    return columns, root, bad


def _as_text(values: pa.Array, root: np.ndarray, bad: np.ndarray) -> pa.Array:
    """Texts of byte values; a value that is not UTF-8 marks its feed."""
    try:
        return values.cast(pa.string())
    except pa.ArrowInvalid:
        rows = values.to_pylist()
        for n, value in enumerate(rows):
            try:
                rows[n] = None if value is None else value.decode()
            except UnicodeDecodeError:
                rows[n], bad[root[n]] = None, True
        return pa.array(rows, pa.string())


def _decode(raw: DataFrame, ddl: str, rows_of: Callable, on_error: str) -> DataFrame:
    """Decode ``content`` with ``rows_of(bytes, offsets)``, feeds of about RUN_BYTES at a time; mode and load_timestamp pass through."""
    if on_error not in ("raise", "skip"):
        raise ValueError(f"on_error must be 'raise' or 'skip', not {on_error!r}")
    kinds = {n: k for n, k in fields_of(ddl) if n not in ("mode", "load_timestamp")}
    arrow = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    schema = pa.schema([(n, arrow[k]) for n, k in kinds.items()] + [("mode", pa.string()), ("load_timestamp", pa.timestamp("us"))])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # no content is no message, as an empty one
            content = pc.fill_null(batch.column("content").cast(pa.large_binary()), b"")
            lengths = pc.binary_length(content).to_numpy()
            runs = np.cumsum(lengths) // RUN_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(content)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = content.slice(a, b - a)
                offsets = np.concatenate([[0], np.cumsum(lengths[a:b])]).astype(np.int64)
                first = int(np.frombuffer(part.buffers()[1], np.int64)[part.offset])
                held = part.buffers()[2]
                data = np.zeros(int(offsets[-1]) + wire.PADDING, np.uint8)
                if offsets[-1]:
                    data[: offsets[-1]] = np.frombuffer(held, np.uint8)[first : first + int(offsets[-1])]
                columns, root, bad = rows_of(data, offsets)
                columns = {n: _as_text(c, root, bad) if kinds[n] == "string" else c for n, c in columns.items()}
                if bad.any() and on_error == "raise":
                    raise ValueError(f"{int(bad.sum())} of {len(bad)} messages can't be parsed")
                of_feed = pa.array(root + a)
                columns |= {n: batch.column(n).take(of_feed).cast(schema.field(n).type) for n in ("mode", "load_timestamp")}
                rows = [columns.get(f.name, pa.nulls(len(root), f.type)).cast(f.type) for f in schema]
                yield pa.RecordBatch.from_arrays(rows, schema=schema).filter(pa.array(~bad[root]))

    shape = ", ".join(f"{n} {k}" for n, k in kinds.items()) + ", mode string, load_timestamp timestamp_ntz"
    ordered = [n for n, _ in fields_of(ddl)]
    return raw.select("content", "mode", "load_timestamp").mapInArrow(decode, shape).select(*ordered)


def decode_trip_updates(raw: DataFrame, absent_time_as_zero: bool = False, on_error: str = "raise") -> DataFrame:
    """One row per stop time update of ``raw`` (content, mode, load_timestamp).

    Absent fields are NULL, and so are unsigned numbers that their column can't hold. ``absent_time_as_zero`` gives 0
    for an event that carries no time. Unknown fields are left out. ``on_error="skip"`` leaves out messages that cannot
    be parsed; only the parts that are read are looked into.
    """
    return _decode(raw, TRIP_UPDATES, lambda data, offsets: _trip_update_rows(data, offsets, absent_time_as_zero), on_error)


def decode_vehicle_positions(raw: DataFrame, on_error: str = "raise") -> DataFrame:
    """One row per vehicle entity; four columns without a flat value stay NULL."""
    return _decode(raw, VEHICLE_POSITIONS, _vehicle_rows, on_error)


# landed message files: <kind>_<mode>_<yyyyMMdd_HHmmss>.pb
_FILE = r"([^/]*)_([A-Z]+)_(\d{8}_\d{6})\.pb$"


def with_file_facts(files: DataFrame) -> DataFrame:
    """Kind, mode and load time of landed message files from their names; other files are left out."""
    part = lambda i: F.regexp_extract("path", _FILE, i)
    moment = F.try_to_timestamp(part(3), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")
    return files.select("content", part(1).alias("kind"), part(2).alias("mode"), moment.alias("load_timestamp")).filter(
        F.col("load_timestamp").isNotNull()
    )


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return with_file_facts(spark.read.format("binaryFile").option("pathGlobFilter", "*.pb").load(path))
