"""Record types of the event model, their defaults and allowed values."""

from __future__ import annotations

from pyspark.sql import types as T

# Prices and quantities on ingest; amounts (price times quantity) and balances in the ledger.
MONEY = T.DecimalType(18, 8)
LEDGER = T.DecimalType(36, 16)

# Enum constants of the record types.
LIMIT_SELL, LIMIT_BUY = "LIMIT_SELL", "LIMIT_BUY"
ORDER_TYPES = (LIMIT_SELL, LIMIT_BUY)
NEW, CONFIRMED, PROCESSED = "NEW", "CONFIRMED", "PROCESSED"
PARTIALLY_FILLED, FILLED, CANCELLED, REJECTED = "PARTIALLY_FILLED", "FILLED", "CANCELLED", "REJECTED"
ORDER_STATUSES = (NEW, CONFIRMED, PROCESSED, PARTIALLY_FILLED, FILLED, CANCELLED, REJECTED)
SUBMIT, CANCEL, FILL = "SUBMIT", "CANCEL", "FILL"
ORDER_COMMANDS = (SUBMIT, CANCEL, FILL)
DEBIT, CREDIT, RELEASE_AND_DEBIT, BLOCK, RELEASE = "DEBIT", "CREDIT", "RELEASE_AND_DEBIT", "BLOCK", "RELEASE"
WALLET_OPERATIONS = (DEBIT, CREDIT, RELEASE_AND_DEBIT, BLOCK, RELEASE)
WALLET_COMMAND_STATUSES = (NEW, CONFIRMED, REJECTED)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


def order_type(price: T.DataType) -> T.StructType:
    return _struct(
        id=T.StringType(),
        baseAssetId=T.StringType(),
        quoteAssetId=T.StringType(),
        walletId=T.StringType(),
        orderType=T.StringType(),
        price=price,
        qty=price,
        qtyFilled=price,
        status=T.StringType(),
        message=T.StringType(),
    )


def order_command_type(price: T.DataType) -> T.StructType:
    return _struct(
        id=T.StringType(),
        orderId=T.StringType(),
        causeId=T.StringType(),
        command=T.StringType(),
        fillQty=price,
        fillPrice=price,
        message=T.StringType(),
        order=order_type(price),
    )


def match_type(price: T.DataType) -> T.StructType:
    return _struct(
        matchId=T.StringType(),
        leftOrder=order_type(price),
        rightOrder=order_type(price),
        qtyFilled=price,
        price=price,
    )


def wallet_command_type(amount: T.DataType) -> T.StructType:
    return _struct(
        id=T.StringType(),
        causeId=T.StringType(),
        walletId=T.StringType(),
        assetId=T.StringType(),
        operation=T.StringType(),
        amount=amount,
        amountRelease=amount,
        status=T.StringType(),
        message=T.StringType(),
    )


def asset_type(amount: T.DataType) -> T.StructType:
    return _struct(assetId=T.StringType(), amount=amount, blocked=amount)


def wallet_type(amount: T.DataType) -> T.StructType:
    return _struct(
        walletId=T.StringType(), assets=T.MapType(T.StringType(), asset_type(amount)), txCount=T.LongType()
    )


def event_type(price: T.DataType, amount: T.DataType) -> T.StructType:
    return _struct(
        id=T.StringType(),
        ordersMatchCommand=match_type(price),
        orderCommand=order_command_type(price),
        order=order_type(price),
        walletCommand=wallet_command_type(amount),
        wallet=wallet_type(amount),
    )


# JSON carries doubles; the engine computes in decimals so that equality and sums are exact.
WIRE_EVENT = event_type(T.DoubleType(), T.DoubleType())
WIRE_EVENTS = _struct(events=T.ArrayType(WIRE_EVENT))
EVENT = event_type(MONEY, LEDGER)
ORDER = order_type(MONEY)
ORDER_COMMAND = order_command_type(MONEY)
MATCH = match_type(MONEY)
WALLET_COMMAND = wallet_command_type(LEDGER)
WALLET = wallet_type(LEDGER)

# Defaults of optional fields that a JSON record leaves out.
ORDER_DEFAULTS = {"price": 1.0, "qty": 0.0, "qtyFilled": 0.0, "status": NEW, "message": ""}
ORDER_COMMAND_DEFAULTS = {"fillQty": 0.0, "fillPrice": 0.0, "message": ""}
WALLET_COMMAND_DEFAULTS = {"amount": 0.0, "amountRelease": 0.0, "status": NEW, "message": ""}
WALLET_DEFAULTS = {"txCount": 0}

# Keyed state. An order's `seq` is the log position it arrived at, its time priority in the book.
ORDER_STATE = T.StructType([*ORDER.fields, T.StructField("seq", T.LongType())])
WALLET_STATE = _struct(
    walletId=T.StringType(),
    assetId=T.StringType(),
    amount=LEDGER,
    blocked=LEDGER,
    txCount=T.LongType(),
    held=T.BooleanType(),
)
