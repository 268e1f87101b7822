"""The full refresh: raw text tables to published marts, each layer stored before the next reads it.

Stored layers keep every plan short, survive lost executors, and give Catalyst measured table sizes for its
choice between broadcast and shuffle joins.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators import quality
from riskflow.operators.cascade import Cascade, Reference, cascade_delete
from riskflow.operators.joins import Splits
from riskflow.plans import dds, dm, ods, publish
from riskflow.schemas import DATE_BOUNDS
from riskflow.session import together
from riskflow.sources.writers import write_refresh

Tables = dict[str, DataFrame]

STAR_KEYS = {
    "clients": ["client_id"],
    "activity_types": ["activity_type_id"],
    "currencies": ["currency_id"],
    "payment_methods": ["payment_method_id"],
    "transaction_types": ["transaction_type_id"],
    "clients_activity": ["client_id", "activity_date"],
    "logins": ["client_id", "login_date"],
    "payments": ["payment_id"],
    "transactions": ["transaction_id"],
}
FACTS = ("clients_activity", "logins", "payments", "transactions")
# The references between the tables of the star schema.
STAR_REFERENCES = [
    Reference("clients_activity", "client_id", "clients", "client_id"),
    Reference("clients_activity", "activity_type", "activity_types", "activity_type_id"),
    Reference("logins", "client_id", "clients", "client_id"),
    Reference("payments", "client_id", "clients", "client_id"),
    Reference("payments", "currency", "currencies", "currency_id"),
    Reference("payments", "payment_method", "payment_methods", "payment_method_id"),
    Reference("transactions", "client_id", "clients", "client_id"),
    Reference("transactions", "currency", "currencies", "currency_id"),
    Reference("transactions", "transaction_type", "transaction_types", "transaction_type_id"),
]


def _store(root: str, loads: Mapping[str, Callable[[], DataFrame]]) -> Tables:
    """Build and write independent tables at the same time."""
    return together({name: lambda n=name, b=build: write_refresh(b(), f"{root}/{n}") for name, build in loads.items()})


def refresh_ods(raw: Mapping[str, DataFrame], root: str, strict: bool = True) -> Tables:
    """``raw`` maps clients, clients_activity, logins, payments and transactions to text tables."""
    return _store(
        f"{root}/ods",
        {
            "clients": lambda: ods.ods_clients(raw["clients"]),
            "clients_activity": lambda: ods.ods_activity(raw["clients_activity"]),
            "logins": lambda: ods.ods_logins(raw["logins"]),
            "payments": lambda: ods.ods_payments(raw["payments"], strict),
            "transactions": lambda: ods.ods_transactions(raw["transactions"], strict),
        },
    )


def refresh_dds(
    typed: Mapping[str, DataFrame], root: str, bounds: Mapping[str, tuple[str, str]] | None = None
) -> Tables:
    """Dimensions before facts. ``bounds`` replaces the date range of single facts.

    A fact is written as it leaves its key deduplication, hash-distributed by its key, without a further
    shuffle for the layout.
    """
    limits = {n: DATE_BOUNDS for n in ("clients_activity", "logins", "payments", "transactions")} | dict(bounds or {})
    dims = _store(
        f"{root}/dds",
        {
            "clients": lambda: dds.dds_clients(typed["clients"]),
            "activity_types": lambda: dds.dim_activity_types(typed["clients_activity"]),
            "currencies": lambda: dds.dim_currencies(typed["payments"]),
            "payment_methods": lambda: dds.dim_payment_methods(typed["payments"]),
            "transaction_types": lambda: dds.dim_transaction_types(typed["transactions"]),
        },
    )
    facts = _store(
        f"{root}/dds",
        {
            "clients_activity": lambda: dds.fact_activity(
                typed["clients_activity"], dims["activity_types"], limits["clients_activity"]
            ),
            "logins": lambda: dds.fact_logins(typed["logins"], limits["logins"]),
            "payments": lambda: dds.fact_payments(
                typed["payments"], dims["currencies"], dims["payment_methods"], limits["payments"]
            ),
            "transactions": lambda: dds.fact_transactions(
                typed["transactions"], dims["currencies"], dims["transaction_types"], limits["transactions"]
            ),
        },
    )
    return dims | facts


def refresh_dds_with_rejects(
    typed: Mapping[str, DataFrame],
    root: str,
    bounds: Mapping[str, tuple[str, str]] | None = None,
    unique_clients: bool = False,
) -> tuple[Tables, Tables]:
    """As ``refresh_dds``, with the rejected rows of all nine tables and the rule that each breaks.

    Every typed row is accepted or rejected, those outside the date bounds too. With ``unique_clients``, rows of a
    repeated client id after the first are rejected, so the marts can be built.
    """
    limits = {n: DATE_BOUNDS for n in FACTS} | dict(bounds or {})
    clients = dds.judged_clients(typed["clients"], unique_clients)
    dims = _store(
        f"{root}/dds",
        {
            "clients": lambda: clients.accepted,
            "activity_types": lambda: dds.dim_activity_types(typed["clients_activity"]),
            "currencies": lambda: dds.dim_currencies(typed["payments"]),
            "payment_methods": lambda: dds.dim_payment_methods(typed["payments"]),
            "transaction_types": lambda: dds.dim_transaction_types(typed["transactions"]),
        },
    )
    currencies = dims["currencies"]
    judged = together(
        {
            "clients_activity": lambda: dds.judged_activity(
                typed["clients_activity"], dims["activity_types"], limits["clients_activity"]
            ),
            "logins": lambda: dds.judged_logins(typed["logins"], limits["logins"]),
            "payments": lambda: dds.judged_payments(
                typed["payments"], currencies, dims["payment_methods"], limits["payments"]
            ),
            "transactions": lambda: dds.judged_transactions(
                typed["transactions"], currencies, dims["transaction_types"], limits["transactions"]
            ),
        }
    )
    facts = _store(f"{root}/dds", {n: lambda n=n: judged[n].accepted for n in FACTS})
    refused = {"clients": clients.rejected} | dds.rejected_names(typed, dims) | {n: judged[n].rejected for n in FACTS}
    return dims | facts, _store(f"{root}/rejects", {n: lambda n=n: refused[n] for n in refused})


def star_checks(star: Mapping[str, DataFrame]) -> DataFrame:
    """(check, target, violations) of the keys of all star tables and of the facts' references to clients."""
    keys = [quality.primary_key(star[t], k).withColumn("target", F.lit(f"{t}.{','.join(k)}")) for t, k in STAR_KEYS.items()]
    owned = [
        quality.foreign_key(star[t], "client_id", star["clients"], "client_id").withColumn("target", F.lit(f"{t}.client_id"))
        for t in FACTS
    ]
    return quality.all_checks(*keys, *owned)


def delete_from_star(star: Mapping[str, DataFrame], root: str, doomed: Mapping[str, DataFrame]) -> tuple[Tables, Cascade]:
    """Delete rows of the stored star schema and all facts that refer to them; the tables as replaced.

    ``doomed`` maps a table to the keys that go. Only tables that lose rows are written, each from itself.
    """
    done = cascade_delete(star, STAR_REFERENCES, doomed)
    touched = [n for n in star if not done.removed[n].isEmpty()]
    written = _store(f"{root}/dds", {n: lambda n=n: done.left[n] for n in touched}) if touched else {}
    return dict(star) | written, done


def require_unique_clients(clients: DataFrame) -> None:
    """Stop where a client id repeats: each mart row of this client would multiply.

    The keys of dimensions and facts hold by the way these are built, so clients alone need the gate.
    """
    broken = quality.primary_key(clients, STAR_KEYS["clients"]).first().violations
    if broken:
        raise ValueError(f"{broken} client ids are repeated")


def refresh_dm(star: Mapping[str, DataFrame], root: str, splits: Splits = Splits()) -> Tables:
    clients, currencies = star["clients"], star["currencies"]
    return _store(
        f"{root}/dm",
        {
            "activity_logins": lambda: dm.mart_activity_logins(
                star["clients_activity"], star["activity_types"], clients, star["logins"], splits
            ),
            "transactions": lambda: dm.mart_transactions(
                star["transactions"], clients, currencies, star["transaction_types"], splits
            ),
            "payments": lambda: dm.mart_payments(
                star["payments"], clients, currencies, star["payment_methods"], star["transactions"], splits
            ),
        },
    )


def refresh_published(marts: Mapping[str, DataFrame], root: str) -> Tables:
    """One mart after the other: while it is sorted, all its rows lie in shuffle files, which go with its load."""
    loads = {
        "activity_logins": publish.publish_activity,
        "transactions": publish.publish_transactions,
        "payments": publish.publish_payments,
    }
    return {n: load(marts[n], f"{root}/published/{n}") for n, load in loads.items()}


def refresh_all(
    raw: Mapping[str, DataFrame],
    root: str,
    strict: bool = True,
    bounds: Mapping[str, tuple[str, str]] | None = None,
    splits: Splits = Splits(),
    unique_clients: bool = True,
    keep_rejects: bool = False,
) -> dict[str, Tables]:
    """All layers in order. A repeated client id stops it before the marts, unless ``unique_clients`` is off.

    With ``keep_rejects`` a repeated client id stops nothing: its further rows are rejected, and ``rejects`` holds
    every row that a star table refuses, with the rule that it breaks.
    """
    typed = refresh_ods(raw, root, strict)
    layers = {"ods": typed}
    if keep_rejects:
        star, layers["rejects"] = refresh_dds_with_rejects(typed, root, bounds, unique_clients)
    else:
        star = refresh_dds(typed, root, bounds)
        if unique_clients:
            require_unique_clients(star["clients"])
    marts = refresh_dm(star, root, splits)
    return layers | {"dds": star, "dm": marts, "published": refresh_published(marts, root)}
