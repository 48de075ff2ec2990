"""Small inputs of our own with known results."""

import json


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _plant(species, height, country, bed):
    return json.dumps({"species": species, "height": height, "origin": {"country": country, "bed": bed}})


#: Two share a country; one name has the separator twice, one at its end, one not at all.
PLANTS = [
    (7, _plant("rose-tea-red", 80, "Kenya", "north")),
    (3, _plant("fern", 45, "Peru", "shade")),
    (9, _plant("agave-", 210, "Peru", "south")),
    (1, _plant("sedge-blue", 30, "Norway", "pond")),
    (5, _plant("lily-white", 45, "Peru", "pond")),
]
PLANT_ROWS = [
    (1, "sedge-blue", "30", "Norway"), (3, "fern", "45", "Peru"), (5, "lily-white", "45", "Peru"),
    (7, "rose-tea-red", "80", "Kenya"), (9, "agave-", "210", "Peru"),
]
PATHS = {"species": "$.species", "height": "$.height", "country": "$.origin.country"}
PRICES = [(1, 4.5), (5, 12.0), (9, 30.0), (11, 1.0)]

#: (sensor, event time in ms): a boundary, a gap, two in one window.
READINGS = [("roof", 3), ("cellar", 4), ("roof", 9), ("roof", 10), ("cellar", 12), ("cellar", 19), ("roof", 31)]
READING_WINDOWS = [
    ("roof", 0, 10, 2), ("cellar", 0, 10, 1), ("roof", 10, 20, 1), ("cellar", 10, 20, 2), ("roof", 30, 40, 1)]

#: In order up to 42, then older ones: two whose window is closed by then, one whose window is still open.
DELAYED = [("roof", 2), ("cellar", 6), ("roof", 14), ("roof", 42), ("cellar", 25), ("cellar", 27), ("roof", 44)]
ON_TIME = 4
DELAYED_WINDOWS = [
    ("roof", 0, 10, 1), ("cellar", 0, 10, 1), ("roof", 10, 20, 1), ("cellar", 20, 30, 2), ("roof", 40, 50, 2)]
LATE_WINDOW = ("cellar", 20, 30, 2)

#: (time, meter, amount), out of order within a meter, one time twice.
METERED = [
    ("2023-05-01T12:00:10", "gas", 1.5), ("2023-05-01T12:00:00", "gas", 2.0), ("2023-05-01T12:00:04", "water", 10.0),
    ("2023-05-01T12:00:10", "gas", 0.5), ("2023-05-01T12:00:30", "water", -4.0), ("2023-05-01T12:00:11", "gas", 7.0),
]

#: Numbered texts, one of them twice.
NOTES = [(10, "ebb"), (11, "flow"), (12, None), (13, "ebb"), (13, "ebb")]

#: (country, id, count): one country twice, the second time lower.
STOCK = [("Peru", 1, 40), ("Kenya", 2, 15), ("Norway", 3, 22), ("Peru", 4, 9)]


def change(op, before, after, ts_ms=1700000000123):
    source = {"version": "9.9", "connector": "any", "name": "shop", "ts_ms": ts_ms - 5, "snapshot": "false", "db": "shop",
              "schema": "main", "table_name": "members", "change_lsn": "07", "commit_lsn": "08", "event_serial_no": 1}
    return json.dumps({"source": source, "op": op, "ts_ms": ts_ms, "before": before, "after": after})


OLD = {"id": 52, "first_name": "Mo", "last_name": "Ek", "email": "mo@one.example"}
NEW = {**OLD, "last_name": "Ekdal", "email": None}

#: A nested event: leaves of several types, an empty object, an array.
ORDER_EVENT = json.dumps({
    "order": {"id": "o-9", "placed": "2023-05-01T12:00:59", "total": {"value": 1995, "scale": 2}},
    "rate": 0.25, "gift": True, "notes": {}, "lines": [1, 2],
})
ORDER_SCHEMA = ("order STRUCT<id: STRING, placed: STRING, total: STRUCT<value: BIGINT, scale: INT>>, "
                "rate DOUBLE, gift BOOLEAN, notes MAP<STRING, STRING>, lines ARRAY<INT>")
