"""A hand-made shop: edge rows that the star-schema test tables do not have."""

from datetime import datetime

from marketloom.sources.schemas import SOURCES


def ts(text):
    return datetime.fromisoformat(text) if text else None


def order(oid, cust, status, bought, delivered=None, estimated=None):
    day = ts(bought)
    return (
        oid, cust, status, day, day, day if delivered else None, ts(delivered),
        ts(estimated) or day,
    )


ROWS = {
    "customers": [
        ("c1", "u1", "01001", "são paulo", "SP"),
        ("c2", "u2", "1002", "embu-guacu", "sp"),
        ("c3", "u3", "20000", "santa barbara d'oeste", "RJ"),
    ],
    "sellers": [("s1", "01001", "são paulo", "SP"), ("s2", "99999", "nowhere", "XX")],
    "geolocation": [
        ("01001", -23.5, -46.6, "são paulo", "SP"),
        ("01001", -23.6, -46.7, "sao paulo", "SP"),
        ("20000", -22.9, -43.2, "rio", "RJ"),
    ],
    "orders": [
        order("o1", "c1", "delivered", "2017-01-01 10:00:00", "2017-01-05 10:00:00",
              "2017-01-06 22:00:00"),
        order("o2", "c1", "delivered", "2017-02-01 10:00:00", "2017-02-20 10:00:00",
              "2017-02-10 00:00:00"),
        order("o3", "c2", "canceled", "2017-03-01 10:00:00", None, "2017-03-20 00:00:00"),
        order("o4", "c2", "created", "2017-11-05 10:00:00", None, "2017-11-20 00:00:00"),
    ],
    "order_items": [
        ("o1", 1, "p1", "s1", ts("2017-01-03"), "100.00", "10.00"),
        ("o1", 2, "p1", "s1", ts("2017-01-03"), "100.00", "10.00"),
        ("o1", 3, "p2", "s2", ts("2017-01-04"), "0.00", "0.00"),
        ("o2", 1, "p1", "s1", ts("2017-02-03"), "300.01", "9.99"),
        ("o3", 1, "p2", "s1", ts("2017-03-03"), "50.00", "5.00"),
    ],
    "order_payments": [
        ("o1", 1, "credit_card", 3, "200.00"),
        ("o1", 2, "voucher", 1, "20.00"),
        ("o2", 1, "boleto", 0, "300.00"),
        ("o3", 1, "debit_card", 1, "55.00"),
    ],
    "order_reviews": [
        ("r1", "o1", 5, None, "muito bom", ts("2017-01-10"), ts("2017-01-11 12:00:00")),
        ("r2", "o1", 1, None, None, ts("2017-01-12"), ts("2017-01-13")),
        ("r3", "o2", 3, "t", "   ", ts("2017-02-25"), ts("2017-02-26")),
    ],
    "products": [
        ("p1", "cama", 10, 100, 1, 2000.0, 10.0, 10.0, 100.0),
        ("p2", None, 10, 100, 1, None, 10.0, None, 10.0),
        ("p3", "sem_traducao", 10, 100, 1, 9999.0, 50.0, 50.0, 50.0),
    ],
    "product_categories": [("cama", "bed")],
}


def shop(spark, **changed):
    """Source tables as DataFrames of their declared types."""
    out = {}
    for name, rows in {**ROWS, **changed}.items():
        schema = SOURCES[name].schema
        text = [tuple(None if v is None else str(v) for v in r) for r in rows]
        ddl = ", ".join(f"{f.name} string" for f in schema.fields)
        out[name] = spark.createDataFrame(text, ddl)
    return out
