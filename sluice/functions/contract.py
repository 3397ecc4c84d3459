"""Declared schemas: which columns are typed, and how."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

# Accepted type names and the Spark type each one stands for.
TYPE_NAMES = {
    "Int64": "bigint",
    "float64": "double",
    "string": "string",
    "bigint": "bigint",
    "double": "double",
}


@dataclass(frozen=True)
class Contract:
    """A partial schema, bound to a file by header name.

    ``types`` maps a column to ``bigint``, ``double`` or ``string``;
    ``timestamps`` maps a column to its pattern, or to ``None`` for a form of ISO
    8601, the same for all its cells: ``yyyy-MM-dd HH:mm:ss[.SSSSSS]``, that
    with ``T`` for the space, or ``yyyy-MM-dd``. A column the file has and the contract
    does not name stays text. A typed column the file lacks is left out; a
    missing timestamp column is an error.
    """

    types: Mapping[str, str]
    timestamps: Mapping[str, str | None]

    @staticmethod
    def of(
        types: Mapping[str, str] | None = None,
        timestamps: Iterable[str] | Mapping[str, str | None] = (),
    ) -> Contract:
        types = dict(types or {})
        unknown = {name: kind for name, kind in types.items() if kind not in TYPE_NAMES}
        if unknown:
            raise ValueError(f"unknown column types: {unknown}")
        if not isinstance(timestamps, Mapping):
            timestamps = dict.fromkeys(timestamps)
        return Contract({n: TYPE_NAMES[k] for n, k in types.items()}, dict(timestamps))

    def kind(self, name: str) -> str:
        """Type name for one column of a file."""
        if name in self.timestamps:
            return "timestamp_ntz"
        return self.types.get(name, "string")

    def require(self, header: Iterable[str]) -> None:
        missing = sorted(set(self.timestamps) - set(header))
        if missing:
            raise ValueError(f"timestamp columns missing from the file: {missing}")


# The column types of the monthly taxi trip files.
TRIPS = Contract.of(
    types={
        "VendorID": "Int64",
        "passenger_count": "Int64",
        "trip_distance": "float64",
        "RatecodeID": "Int64",
        "store_and_fwd_flag": "string",
        "PULocationID": "Int64",
        "DOLocationID": "Int64",
        "payment_type": "Int64",
        "fare_amount": "float64",
        "extra": "float64",
        "mta_tax": "float64",
        "tip_amount": "float64",
        "tolls_amount": "float64",
        "improvement_surcharge": "float64",
        "total_amount": "float64",
        "congestion_surcharge": "float64",
    },
    timestamps=["tpep_pickup_datetime", "tpep_dropoff_datetime"],
)
