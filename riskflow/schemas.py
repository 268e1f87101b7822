"""Entity schemas, null tokens and date bounds."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The text forms under which a missing value arrives.
NULL_TOKENS = ("NaN", '"NaN"', "\\NaN\\", "NaT", "")
# Fixed value: the text that marks a name as unusable.
NAME_TOKEN = "NaN"
# The inclusive range of believable dates.
DATE_BOUNDS = ("2010-01-01", "2026-01-01")

_text = T.StringType()
_real = T.DoubleType()


@dataclass(frozen=True)
class Entity:
    """One message type: its wire fields in order, the first of which is the key of the message."""

    name: str
    wire: dict[str, T.DataType]
    instants: tuple[str, ...] = ()  # fields that come as text and are instants
    multiline: bool = False
    lengths: dict[str, int] = field(default_factory=dict)

    @property
    def key(self) -> str:
        return next(iter(self.wire))

    @property
    def wire_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, True) for n, t in self.wire.items()])

    @property
    def typed_schema(self) -> T.StructType:
        """The wire's fields with the types that an ingested table has."""
        own = dict.fromkeys(self.instants, T.TimestampType())
        return T.StructType([T.StructField(n, own.get(n, t), True) for n, t in self.wire.items()])

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType(), True) for n in self.wire])


# Field names, wire types and length bounds of the five entities.
CLIENTS = Entity(
    "clients",
    {
        "client_id": _real,
        "client_first_name": _text,
        "client_last_name": _text,
        "client_email": _text,
        "client_phone": _text,
        "client_address": _text,
        "client_birthday": _text,
    },
    instants=("client_birthday",),
    multiline=True,
    lengths={"client_first_name": 50, "client_last_name": 50, "client_email": 255, "client_phone": 30},
)
ACTIVITY = Entity(
    "clients_activity",
    {
        "client_id": _real,
        "activity_date": _text,
        "activity_type": _text,
        "activity_location": _text,
        "ip_address": _text,
        "device": _text,
    },
    instants=("activity_date",),
    lengths={"activity_type": 50, "activity_location": 255, "device": 255},
)
LOGINS = Entity(
    "logins",
    {"client_id": _real, "login_date": _text, "ip_address": _text, "location": _text, "device": _text},
    instants=("login_date",),
    lengths={"location": 255, "device": 255},
)
PAYMENTS = Entity(
    "payments",
    {
        "client_id": _real,
        "payment_id": _real,
        "payment_date": _text,
        "currency": _text,
        "amount": _real,
        "payment_method": _text,
    },
    instants=("payment_date",),
    lengths={"currency": 10, "payment_method": 50},
)
TRANSACTIONS = Entity(
    "transactions",
    {
        "client_id": _real,
        "transaction_id": _real,
        "transaction_date": _text,
        "transaction_type": _text,
        "account_number": _text,
        "currency": _text,
        "amount": _real,
        "record_saved_at": _text,
    },
    instants=("transaction_date",),
    lengths={"transaction_type": 50, "account_number": 100, "currency": 10, "record_saved_at": 50},
)

ENTITIES = {e.name: e for e in (CLIENTS, ACTIVITY, LOGINS, PAYMENTS, TRANSACTIONS)}
