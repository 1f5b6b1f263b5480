"""Hand-made raw trips."""

from __future__ import annotations

from datetime import datetime

from tripmill.schemas import SERVICES

DEFAULTS = {
    "VendorID": 1,
    "pickup": "2019-03-05 10:00:00",
    "dropoff": "2019-03-05 10:30:00",
    "RatecodeID": 1.0,
    "PULocationID": 1,
    "DOLocationID": 2,
    "passenger_count": 1,
    "trip_distance": 2.5,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 13.3,
    "payment_type": 1,
    "congestion_surcharge": 2.5,
}
TYPES = {
    "VendorID": "bigint",
    "RatecodeID": "double",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "passenger_count": "bigint",
    "payment_type": "bigint",
}


def stamp(text):
    return None if text is None else datetime.fromisoformat(text)


def raw(spark, rows, service="Yellow", types=None):
    """Raw trips of one service; each row overrides some defaults."""
    pickup, dropoff = SERVICES[service]
    known = {**TYPES, **(types or {})}
    names = [{"pickup": pickup, "dropoff": dropoff}.get(c, c) for c in DEFAULTS]
    ddl = ", ".join(
        f"{n} {'timestamp_ntz' if n in (pickup, dropoff) else known.get(n, 'double')}" for n in names
    )
    data = []
    for row in rows:
        full = {**DEFAULTS, **row}
        full["pickup"], full["dropoff"] = stamp(full["pickup"]), stamp(full["dropoff"])
        data.append(tuple(full.values()))
    return spark.createDataFrame(data, ddl)


def zones(spark, rows=None):
    rows = rows or [
        (1, "EWR", "Newark", "EWR"),
        (2, "Queens", "Corona", "Boro Zone"),
        (3, "Queens", "Corona", "Boro Zone"),
        (4, "Manhattan", "Alphabet", "Yellow Zone"),
    ]
    return spark.createDataFrame(rows, "locationid bigint, borough string, zone string, service_zone string")
