"""JSON events to typed records and back, with unreadable records set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbourse import schemas as S
from sparkbourse.functions.orders import stable_id_sql

CORRUPT = "_corrupt"
_PARSED = T.StructType([*S.EVENT.fields, T.StructField(CORRUPT, T.StringType())])

# Record type by the path that leads to it: required fields, defaults and fields with allowed values.
_ORDER = (
    ("id", "baseAssetId", "quoteAssetId", "walletId", "orderType"),
    S.ORDER_DEFAULTS,
    {"orderType": S.ORDER_TYPES, "status": S.ORDER_STATUSES},
)
_RULES = {
    "order": _ORDER,
    "orderCommand.order": _ORDER,
    "ordersMatchCommand.leftOrder": _ORDER,
    "ordersMatchCommand.rightOrder": _ORDER,
    "ordersMatchCommand": (("matchId", "leftOrder", "rightOrder"), {"qtyFilled": 0.0, "price": 0.0}, {}),
    "orderCommand": (("id", "orderId", "causeId", "command"), S.ORDER_COMMAND_DEFAULTS, {"command": S.ORDER_COMMANDS}),
    "walletCommand": (
        ("id", "causeId", "walletId", "assetId", "operation"),
        S.WALLET_COMMAND_DEFAULTS,
        {"operation": S.WALLET_OPERATIONS, "status": S.WALLET_COMMAND_STATUSES},
    ),
    "wallet": (("walletId", "assets"), S.WALLET_DEFAULTS, {}),
}


def _sql(*names: str) -> str:
    return ".".join(f"`{part}`" for name in names for part in name.split("."))


def _literal(value: object, dtype: T.DataType) -> str:
    return f"CAST('{value}' AS {dtype.simpleString()})"


def _completed(path: str, dtype: T.StructType) -> str:
    """SQL for a copy of a record with the defaults of absent fields filled in."""
    defaults = _RULES[path][1]
    fields = []
    for f in dtype.fields:
        value = _sql("_record", path, f.name)
        if isinstance(f.dataType, T.StructType):
            value = _completed(f"{path}.{f.name}", f.dataType)
        elif f.name in defaults:
            value = f"coalesce({value}, {_literal(defaults[f.name], f.dataType)})"
        fields.append(f"'{f.name}', {value}")
    return f"CASE WHEN {_sql('_record', path)} IS NOT NULL THEN named_struct({', '.join(fields)}) END"


def _first_fault() -> str:
    """SQL for what is wrong with a record, NULL if nothing is."""
    corrupt = f"_record IS NULL OR {_sql('_record', CORRUPT)} IS NOT NULL"
    faults = [f"CASE WHEN {corrupt} THEN 'unreadable JSON or number' END"]
    for path, (required, _, allowed) in _RULES.items():
        missing = " OR ".join(f"{_sql('_record', path, name)} IS NULL" for name in required)
        checks = [f"CASE WHEN {missing} THEN 'missing field in {path}' END"]
        for name, values in allowed.items():
            listed = ", ".join(f"'{v}'" for v in values)
            checks.append(f"CASE WHEN {_sql('_record', path, name)} NOT IN ({listed}) THEN 'unknown {name} in {path}' END")
        # Most parts of an event are absent; those cost one look.
        faults.append(f"CASE WHEN {_sql('_record', path)} IS NOT NULL THEN coalesce({', '.join(checks)}) END")
    return f"coalesce({', '.join(faults)})"


# As SQL text because building the same from Column objects takes a call into the JVM per field.
_PARTS = ", ".join(
    f"'{f.name}', {_completed(f.name, f.dataType)}" for f in S.EVENT.fields if isinstance(f.dataType, T.StructType)
)
_EVENT_ID = f"coalesce(_record.id, {stable_id_sql('value', 'CAST(seq AS STRING)')})"
_DECODED = (
    f"inline(array(named_struct('event', named_struct('id', {_EVENT_ID}, {_PARTS}), 'reason', {_first_fault()})))"
)


def decode_events(raw: DataFrame) -> DataFrame:
    """``(seq, value, ...)`` to ``(seq, value, ..., event, reason)``; ``reason`` tells why a record cannot be used.

    Numbers are read as decimals straight from the text; one that does not fit makes the record unreadable.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = raw.withColumn("_record", F.from_json("value", _PARSED, options))
    # A generator is not merged into later projections: every record is decoded once, however many fields are read.
    return parsed.selectExpr(*raw.columns, _DECODED)


def decode_bare(raw: DataFrame, part: str) -> DataFrame:
    """Records that hold a single order or command without an envelope, decoded as the ``part`` of an event of their own.

    The same rules hold as in an envelope. A text that brings other parts along is unreadable; as in an envelope, nothing is
    read behind the record's last brace.
    """
    wrapped = raw.withColumns({"_bare": F.col("value"), "value": F.concat(F.lit(f'{{"{part}":'), "value", F.lit("}"))})
    others = [f.name for f in S.EVENT.fields if isinstance(f.dataType, T.StructType) and f.name != part]
    alone = F.col(f"event.{part}").isNotNull()
    for name in others:
        alone = alone & F.col(f"event.{name}").isNull()
    reason = F.when(~alone, "unreadable JSON or number").otherwise(F.col("reason"))
    return decode_events(wrapped).withColumns({"reason": reason, "value": F.col("_bare")}).drop("_bare")


def decode_commands(raw: DataFrame) -> DataFrame:
    """Bare order commands as events."""
    return decode_bare(raw, "orderCommand")


def decode_orders(raw: DataFrame) -> DataFrame:
    """Bare orders as events."""
    return decode_bare(raw, "order")


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable events, and the dead letters with their reason. Good records go on whatever the others hold."""
    good = decoded.filter("reason is null").drop("value", "reason")
    return good, decoded.filter("reason is not null").select("seq", "value", "reason")


def only_needed(decoded: DataFrame) -> DataFrame:
    """Decoded records to be written out: of usable ones the event tells all, of the others the text is read."""
    return decoded.select("seq", F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"), "event", "reason")


def encode_events(events: DataFrame) -> DataFrame:
    """JSON text of events; numbers go out with all their digits and absent parts are left out."""
    return events.withColumn("value", F.to_json("event")).drop("event")


def envelope(event_id: Column, **parts: Column) -> Column:
    """An event with the given sub-records and the others absent."""
    fields = []
    for f in S.EVENT.fields:
        value = event_id if f.name == "id" else parts.get(f.name, F.lit(None))
        fields.append(value.cast(f.dataType).alias(f.name))
    return F.struct(*fields)


def replace_parts(event: Column, **parts: Column | None) -> Column:
    """Copy of an event with some sub-records replaced, or taken out by ``None``."""
    for name, value in parts.items():
        event = event.withField(name, (F.lit(None) if value is None else value).cast(S.EVENT[name].dataType))
    return event


def order_struct(prefix: str | None = None) -> Column:
    """An order record from flat columns."""
    names = [f.name for f in S.ORDER.fields]
    return F.struct(*[F.col(f"{prefix}.{n}" if prefix else n).alias(n) for n in names]).cast(S.ORDER)
