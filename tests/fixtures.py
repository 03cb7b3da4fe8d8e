"""Hand-written event documents for micro-fixtures."""

from __future__ import annotations

import datetime as dt
import json

RAW_SCHEMA = "event_id string, fetched_city string, ingested_at timestamp_ntz, payload string"

R1 = dt.datetime(2024, 1, 1, 6)
R2 = dt.datetime(2024, 1, 2, 6)
R3 = dt.datetime(2024, 1, 3, 6)
R4 = dt.datetime(2024, 1, 4, 6)


def doc(event_id="E1", status="onsale", date="2024-03-01", time="20:00:00", pmin=20, pmax=40.5,
        currency="USD", genre="Rock", artist=("A1", "Artist 1"), venue=("V1", "Venue 1"),
        lat="40.25", lon="-80.5", name="Show 1", **extra) -> str:
    d: dict = {"id": event_id, "name": name, "url": f"https://t.example/{event_id}",
               "dates": {"start": {}, "status": {"code": status}}}
    if date is not None:
        d["dates"]["start"]["localDate"] = date
        d["dates"]["start"]["dateTime"] = f"{date}T01:00:00Z"
    if time is not None:
        d["dates"]["start"]["localTime"] = time
    if genre is not None:
        d["classifications"] = [{"genre": {"name": genre}, "subGenre": {"name": "Sub 1"}}]
    if pmin is not None or pmax is not None or currency is not None:
        pr = {}
        if currency is not None:
            pr["currency"] = currency
        if pmin is not None:
            pr["min"] = pmin
        if pmax is not None:
            pr["max"] = pmax
        d["priceRanges"] = [pr]
    emb: dict = {}
    if venue is not None:
        v = {"id": venue[0], "name": venue[1], "city": {"name": "City 1"}, "state": {"stateCode": "S1"},
             "country": {"countryCode": "US"}, "address": {"line1": "10 Main St"}}
        if lat is not None:
            v["location"] = {"latitude": lat, "longitude": lon}
        emb["venues"] = [v]
    if artist is not None:
        emb["attractions"] = [{"id": artist[0], "name": artist[1]}]
    d["_embedded"] = emb
    d.update(extra)
    return json.dumps(d, separators=(",", ":"))


def raw_df(spark, rows):
    """rows: (event_id, city, ingested_at, payload)."""
    return spark.createDataFrame(rows, RAW_SCHEMA)
